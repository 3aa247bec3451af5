"""Property checks for nesting on generated staged rows."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bookshift.functions import jsonio
from bookshift.operators import nest
from bookshift.operators.nest import FieldSet

ROW = st.tuples(
    st.sampled_from(["a", "b", "c", None]),          # key 1 (nullable)
    st.sampled_from(["x", "y"]),                     # key 2
    st.integers(min_value=0, max_value=10_000),      # order (made unique below)
    st.one_of(st.none(), st.sampled_from(["nan", "p", "q"])),   # array field
    st.one_of(st.none(), st.integers(min_value=-5, max_value=5)),  # array / object field
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=25))
def test_nest_properties(spark, rows):
    rows = [(k1, k2, i, a, b) for i, (k1, k2, _, a, b) in enumerate(rows)]  # total order
    df = spark.createDataFrame(rows, "k1 string, k2 string, seq int, a string, b int")
    sets = [FieldSet("arr", ["a", "b"], array=True), FieldSet("obj", ["b"])]
    docs = nest.nest_field_sets(df, ["k1", "k2"], sets, ["seq"])
    got = docs.collect()
    quarantined = nest.quarantine_null_keys(df, ["k1", "k2"]).count()

    # kept + quarantined = input
    assert sum(r.copies for r in got) + quarantined == len(rows)
    # one document per distinct non-null key; array length = staged rows (unless pruned to null)
    keys = {(k1, k2) for k1, k2, *_ in rows if k1 is not None}
    assert {(r.k1, r.k2) for r in got} == keys
    for r in got:
        assert r.arr is None or len(r.arr) == r.copies
        if r.arr is None:
            assert r.copies == 1
    # no null attribute anywhere in a payload
    for p in jsonio.payload_json(docs, ["k1", "k2"]).collect():
        body = json.loads(p.payload)

        def no_nulls(v):
            if isinstance(v, dict):
                return all(x is not None and no_nulls(x) for x in v.values())
            if isinstance(v, list):
                return all(x is None or no_nulls(x) for x in v)  # pruned elements stay as null (P6)
            return True
        assert no_nulls(body)


def test_entity_with_a_third_of_all_rows(spark):
    from pyspark.sql import functions as F
    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),  # key 0 holds a third
        F.col("id").alias("seq"), (F.col("id") % 7).alias("v"))
    sets = [FieldSet("items", ["v"], array=True), FieldSet("first", ["seq"])]
    whole = nest.nest_field_sets(rows, ["k"], sets, ["seq"])
    hot = whole.where("k = 0").first()
    assert (hot.copies, hot.first.seq) == (n // 3, 0)
    assert [e.v for e in hot["items"]] == [i % 7 for i in range(0, n, 3)]
    assert whole.count() == 1 + (n - n // 3)
    headers = nest.document_headers(rows, ["k"], sets, ["seq"])
    assert headers.columns == ["k", "first", "copies"] and headers.where("k = 0").first().copies == n // 3
    elements = nest.document_elements(rows, ["k"], sets, ["seq"])
    assert elements.count() == n and elements.where("k = 0").count() == n // 3
    firsts = elements.where("k = 0").orderBy("order").limit(3).collect()
    assert [json.loads(e.element)["v"] for e in firsts] == [0, 3 % 7, 6 % 7]
    assert "Exchange" not in elements._jdf.queryExecution().executedPlan().toString()
