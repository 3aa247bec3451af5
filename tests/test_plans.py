"""Plan checks: no Python UDFs, no cartesian products, one shuffle for nesting,
filters and column pruning reaching the scan."""

import pytest

from bookshift.operators import nest
from bookshift.operators.nest import FieldSet
from bookshift.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_and_no_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_nest_is_one_aggregate_shuffle(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    sets = [FieldSet("lines", ["l_linenumber", "l_partkey"], True), FieldSet("flags", ["l_returnflag"]),
            FieldSet("more", ["l_tax"])]
    plan = _plan(nest.nest_field_sets(df, ["l_orderkey"], sets, ["l_linenumber", "l_partkey", "l_suppkey"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_filter_and_projection_reach_the_scan(spark):
    df = QUERIES["scan_cohort_filter"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)" in plan
    assert "o_orderdate" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_top_n_uses_window_group_limit(spark):
    plan = _plan(QUERIES["topn_per_group"](spark, SF))
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_when_nothing_can_be_broadcast(spark, name):
    """At 100 TB the loan-sized tables exceed any broadcast threshold; the
    plans must then still be shuffle joins, never a cartesian product."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["client_payload", "group_payload", "loan_payload", "disbursement_payload"])
def test_documents_write_nothing(spark, name):
    import glob
    folder = spark.conf.get("spark.checkpoint.dir")
    before = glob.glob(f"{folder}/*")
    QUERIES[name](spark, SF).limit(1).collect()
    assert glob.glob(f"{folder}/*") == before


def test_group_documents_nest_once(spark):
    plan = _plan(QUERIES["group_payload"](spark, SF))
    assert plan.count("ObjectHashAggregate") == 2 and plan.count("collect_list") >= 2


def test_loan_accounts_read_tasks_transfers_and_dates_once(spark):
    """Rates, tasks, task types and transfers each read lineitem once; the dates
    (a union of three kinds in the stand-in) are read once as well."""
    plan = _plan(QUERIES["loan_accounts_operational"](spark, SF))
    assert plan.count("lineitem.parquet") == 4
    assert plan.count("FileScan") < 26
