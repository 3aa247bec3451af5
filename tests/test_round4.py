"""Plans at size: master tables never deal a loan-sized table out by their few
values, side-by-side blocks read their source twice, loan documents shuffle
their staged rows once."""

import re

import pytest
from pyspark.sql import functions as F

from bookshift.operators import nest, product
from bookshift.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Plans as of tables too large to be broadcast by their size."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _dealt_by(plan: str) -> list[list[str]]:
    """Columns of every hash shuffle."""
    return [re.findall(r"(\w+)#\d+", x) for x in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)]


@pytest.mark.parametrize("name, few", [
    ("multi_adhoc_repayment", ["kpd_idlink_xtkm"]),
    ("disbursement_details", ["rtm_idlink_xtrm"]),
    ("disbursement_payload", ["rtm_idlink_xtrm"]),
    ("loan_accounts_operational", ["kpd_idlink_xtkm", "rcb_idlink_xrbl", "rmr_idlink_xsu"]),
])
def test_no_shuffle_by_a_type(spark, shuffled, name, few):
    dealt = _dealt_by(_plan(QUERIES[name](spark, SF)))
    assert dealt and not [d for d in dealt if set(d) & set(few)]


def test_f7_other_tasks_go_before_the_shuffle(spark, shuffled):
    plan = _plan(QUERIES["multi_adhoc_repayment"](spark, SF))
    tasks = plan[:plan.rindex("l_suppkey")]
    assert "LeftSemi" in plan and tasks.rindex("LeftSemi") > tasks.rindex("Exchange hashpartitioning(kpd_idlink_code")


def test_f1_blocks_read_their_source_twice(spark, tmp_path):
    spark.range(40).select((F.col("id") % 4).alias("k"), (F.col("id") % 3).alias("kind"), "id").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    sides = {f"s{k}": (F.col("kind") == k, F.struct(F.col("id").alias(f"v{k}"))) for k in range(3)}
    cut = product.beside(df, "k", sides, outer=True, block_rows=1)
    assert _plan(cut).count("FileScan") == 2
    whole = product.beside(df, "k", sides, outer=True)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("name", ["loan_payload", "loan_requests", "loan_payload_cohort"])
def test_f2_staged_loans_are_shuffled_once(spark, shuffled, name):
    dealt = _dealt_by(_plan(QUERIES[name](spark, SF)))
    assert not [d for d in dealt if "test_group" in d or "accountHolderKey" in d]


def test_f2_records_are_sorted_by_one_ordering(spark):
    rows = [("a", 2, None), ("a", None, "z"), ("a", 1, "y"), ("a", 1, None), ("a", None, None), ("a", 2, "b"), ("a", 1, "y")]
    df = spark.createDataFrame(rows, "k string, n int, s string")
    nested = nest.nest_field_sets(df, ["k"], [nest.FieldSet("all", ["n", "s"], True, prune=False)], ["n", "s"])
    assert [tuple(r) for r in nested.first()["all"]] == sorted(
        [r[1:] for r in rows], key=lambda r: tuple((v is not None, v) for v in r))
    plan = nested._jdf.queryExecution().analyzed().toString().lower()
    assert "array_sort(" not in plan and ("sort_array(" in plan or "sortarray(" in plan)
