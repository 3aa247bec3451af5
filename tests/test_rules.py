"""One inline fixture per parity rule (P1-P14) and per tricky function.

Expected values are written from the rule, not from running the code.
"""

import json

import pytest
from pyspark.sql import functions as F

from bookshift.functions import jsonio, scalars, temporal
from bookshift.operators import joins, nest, rows
from bookshift.operators.nest import FieldSet


def test_p1_null_keys_match_in_merge(spark):
    left = spark.createDataFrame([(1, None, "a")], "k1 int, k2 string, v string")
    right = spark.createDataFrame([(1, None, "b")], "k1 int, k2 string, w string")
    out = joins.merge_null_safe(left, right, ["k1", "k2"]).collect()
    assert [tuple(r) for r in out] == [(1, None, "a", "b")]


def test_p1_clashing_names_get_suffixes(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([(1, "b")], "k int, v string")
    out = joins.merge_null_safe(left, right, ["k"])
    assert out.columns == ["k", "v_x", "v_y"]


def _people(spark):
    return spark.createDataFrame(
        [("c1", "Ann", None, 1, "x"), ("c2", "Bob", "M", 2, "y"), ("c2", "Bob", "M", 3, "z")],
        "id string, first string, middle string, seq int, city string")


def test_p2_null_group_key_drops_row_and_is_quarantined(spark):
    df = _people(spark)
    out = nest.nest_field_sets(df, ["id", "first", "middle"], [FieldSet("addr", ["city"], True)], ["seq"])
    assert sorted(r.id for r in out.collect()) == ["c2"]
    q = nest.quarantine_null_keys(df, ["id", "first", "middle"]).collect()
    assert [(r.id, r.null_keys) for r in q] == [("c1", "middle")]
    # kept + quarantined = input
    assert out.agg(F.sum("copies")).first()[0] + len(q) == df.count()


def test_p2_keep_option(spark):
    out = nest.nest_field_sets(_people(spark), ["id", "first", "middle"], [FieldSet("addr", ["city"], True)],
                               ["seq"], null_keys="keep")
    assert sorted(r.id for r in out.collect()) == ["c1", "c2"]


def test_p3_object_is_first_record_whole(spark):
    df = spark.createDataFrame([("k", 2, "late", 20), ("k", 1, "early", None)], "k string, seq int, a string, b int")
    out = nest.nest_object(df, ["k"], "obj", ["a", "b"], ["seq"]).first()
    assert out.obj.a == "early" and out.obj.b is None  # whole first record, not first non-null per field


def test_p4_array_keeps_all_records_in_order_with_duplicates(spark):
    df = spark.createDataFrame([("k", 3, "x"), ("k", 1, "y"), ("k", 2, "y")], "k string, seq int, a string")
    out = nest.nest_array(df, ["k"], "arr", ["a"], ["seq"]).first()
    assert [e.a for e in out.arr] == ["y", "y", "x"]


def test_p5_object_pruning(spark):
    df = spark.createDataFrame([("k1", None, 5), ("k2", None, None)], "k string, a int, b int")
    out = {r.k: r.obj for r in nest.nest_object(df, ["k"], "obj", ["a", "b"], ["k"]).collect()}
    assert out["k1"].b == 5 and out["k1"].a is None
    assert out["k2"] is None
    docs = jsonio.payload_json(nest.nest_object(df, ["k"], "obj", ["a", "b"], ["k"]), ["k"])
    texts = {r.k: json.loads(r.payload) for r in docs.collect()}
    assert texts["k1"] == {"k": "k1", "obj": {"b": 5}}
    assert texts["k2"] == {"k": "k2"}  # attribute absent


def test_p6_array_pruning(spark):
    df = spark.createDataFrame([
        ("only_null", 1, None, None),
        ("null_and_filled", 1, None, None), ("null_and_filled", 2, "a", 1),
        ("two_nulls", 1, None, None), ("two_nulls", 2, None, None),
    ], "k string, seq int, a string, b int")
    out = {r.k: r.arr for r in nest.nest_array(df, ["k"], "arr", ["a", "b"], ["seq"]).collect()}
    assert out["only_null"] is None
    assert out["null_and_filled"][0] is None and out["null_and_filled"][1].a == "a"
    assert list(out["two_nulls"]) == [None, None]


def test_p7_nan_text_only_for_array_elements(spark):
    df = spark.createDataFrame([("k", 1, "nan", "nan"), ("k", 2, "nan", "x")], "k string, seq int, a string, b string")
    arr = nest.nest_array(df, ["k"], "arr", ["a", "b"], ["seq"]).first().arr
    assert arr[0] is None
    assert arr[1].a == "nan" and arr[1].b == "x"
    obj = nest.nest_object(df, ["k"], "obj", ["a", "b"], ["seq"]).first().obj
    assert obj.a == "nan" and obj.b == "nan"


def test_p8_copies_and_expand(spark):
    df = spark.createDataFrame([("c", 1, "l1"), ("c", 2, "l2")], "id string, seq int, line string")
    docs = nest.nest_field_sets(df, ["id"], [FieldSet("addresses", ["line"], True)], ["seq"])
    assert docs.first().copies == 2
    assert nest.expand_copies(docs).count() == 2
    assert nest.duplicate_entities(df, ["id"]).first().staged_rows == 2


def test_p9_sorted_keys_and_null_attributes_left_out(spark):
    df = spark.createDataFrame([(1, None, "z")], "zeta int, alpha string, mid string")
    text = jsonio.payload_json(df, [], "payload").first().payload
    assert text == '{"mid":"z","zeta":1}'


def test_p10_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "k int, score double")
    out = {r.k: r.score for r in scalars.normalise_nulls(df).collect()}
    assert out[1] is None and out[2] == 1.5


def test_p11_null_date_text(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert df.select(scalars.date_text("d")).first()[0] == "None"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Australia/Sydney"])
def test_p12_tz_stamp_under_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("""SELECT * FROM VALUES
            (1, TIMESTAMP_NTZ'2022-12-07 00:00:00'), (2, TIMESTAMP_NTZ'2022-07-01 10:00:00'),
            (3, TIMESTAMP_NTZ'2023-04-02 02:30:00'), (4, TIMESTAMP_NTZ'2022-10-02 02:30:00'),
            (5, CAST(NULL AS TIMESTAMP_NTZ)), (6, TIMESTAMP_NTZ'2022-03-13 02:30:00.5') AS t(i, ts)""")
        got = {r.i: r.s for r in df.select("i", temporal.tz_stamp("ts").alias("s")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert got == {1: "2022-12-07T00:00:00+11:00", 2: "2022-07-01T10:00:00+10:00",
                   3: "2023-04-02T02:30:00+10:00", 4: "2022-10-02T02:30:00+10:00", 5: None,
                   6: "2022-03-13T02:30:00+11:00"}


def test_p13_unknown_role_strict_and_lenient(spark):
    df = spark.createDataFrame([("Primary",), ("tertiary",)], "role string")
    m = {"primary": "k1", "secondary": "k2"}
    lenient = [r[0] for r in df.select(scalars.lookup("role", m, lower=True)).collect()]
    assert lenient == ["k1", None]
    assert [r.role for r in scalars.unmapped_rows(df, "role", m, lower=True).collect()] == ["tertiary"]
    with pytest.raises(Exception, match="unmapped role: tertiary"):
        df.select(scalars.lookup("role", m, strict=True, lower=True, what="role")).collect()


def test_p14_explicit_null_order_and_tie_break(spark):
    df = spark.createDataFrame([
        ("s", 1, None, 10), ("s", 2, 5, None), ("s", 3, 5, 20), ("s", 4, 5, 20), ("s", 5, 7, 1),
    ], "grp string, id int, n int, d int")
    out = rows.top_n_per_group(df, ["grp"], [F.col("n").asc_nulls_last(), F.col("d").desc_nulls_first(),
                                              F.col("id").asc()], 3, "rn")
    assert [r.id for r in out.orderBy("rn").collect()] == [2, 3, 4]


def test_s12_month_add_keeps_time_and_clamps(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2023-01-31 10:00:00' AS ts")
    assert str(df.select(temporal.add_months_keep_time("ts")).first()[0]) == "2023-02-28 10:00:00"


def test_s18_flatten_with_arrays(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":[{"c":1},{"c":2}],"d":"x"}}')], "seq int, body string")
    parsed = df.select("seq", F.from_json("body", "a struct<b: array<struct<c: int>>, d: string>").alias("j"))
    out = jsonio.flatten_json(parsed, "j", keep=["seq"])
    assert out.columns == ["seq", "a_b_0_c", "a_b_1_c", "a_d"]
    assert tuple(out.first()) == (1, 1, 2, "x")


def test_s7_tsql_concat_treats_null_as_empty(spark):
    df = spark.createDataFrame([(None, "b")], "a string, b string")
    assert df.select(scalars.concat_tsql("a", "b")).first()[0] == "b"


def test_f8_like_join_wildcards_and_backslash(spark):
    details = spark.createDataFrame([("Rate\\Acme Co",), ("Rate\\Best_Bank",), ("Rate\\BestXBank",)], "d string")
    names = spark.createDataFrame([("Acme Co",), ("Best_Bank",), ("Nobody",)], "name string")
    got = sorted(tuple(r) for r in joins.like_join(details, "d", names, "Rate\\", "name").collect())
    # '_' stays a wildcard: Best_Bank matches both Best_Bank and BestXBank.
    assert got == [("Rate\\Acme Co", "Acme Co"), ("Rate\\BestXBank", "Best_Bank"), ("Rate\\Best_Bank", "Best_Bank")]
    rows_ = spark.createDataFrame([(1, "Best_Bank"), (2, "Acme Co"), (3, "Best_Bank")], "id int, name string")
    m = joins.like_matches(details, "d", rows_, "Rate\\", "name")
    assert sorted((r.id, r.d) for r in m.collect()) == [
        (1, "Rate\\BestXBank"), (1, "Rate\\Best_Bank"), (2, "Rate\\Acme Co"), (3, "Rate\\BestXBank"),
        (3, "Rate\\Best_Bank")]


def test_row_sequence_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = rows.row_sequence(df, ["k"], "seq", start=5, buckets=4).orderBy("seq").collect()
    assert [r.seq for r in out] == list(range(5, 1005))
    assert [r.k for r in out] == sorted(r.k for r in out)


def test_keep_first_follows_declared_order(spark):
    df = spark.createDataFrame([("a", 3, "z"), ("a", 1, "x"), ("b", 2, "y")], "k string, o int, v string")
    got = {r.k: r.v for r in rows.keep_first(df, ["k"], ["o"]).collect()}
    assert got == {"a": "x", "b": "y"}


def test_s18_long_form_without_schema(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":[1,{"c":2}]},"d":"x"}'), (2, '[true,null]'), (3, '5')],
                               "seq int, body string")
    got = sorted((r.seq, r.path, r.value) for r in jsonio.flatten_json_long(df, "seq", "body").collect())
    assert got == [(1, "a_b_0", "1"), (1, "a_b_1_c", "2"), (1, "d", "x"),
                   (2, "0", "true"), (2, "1", None), (3, "", "5")]


def test_a3_cohort_filters(spark):
    from bookshift.sources.tables import filter_cohort_ids, semi_join_cohort
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "loanid int, v string")
    assert filter_cohort_ids(df, "loanid", []).count() == 0          # empty cohort -> empty result
    assert sorted(r.loanid for r in filter_cohort_ids(df, "loanid", [3, 1]).collect()) == [1, 3]
    cohort = spark.createDataFrame([(2,), (2,), (3,)], "loanid int")  # duplicates do not multiply rows
    assert sorted(r.loanid for r in semi_join_cohort(df, cohort, "loanid").collect()) == [2, 3]


def test_s1_strict_and_lenient_int(spark):
    df = spark.createDataFrame([("12",), ("",)], "t string")
    assert [r[0] for r in df.select(scalars.to_int("t", lenient=True)).collect()] == [12, None]
    with pytest.raises(Exception):
        df.select(scalars.to_int("t")).collect()   # ANSI: '' is not an INT


def test_nest_constants_are_attached_after_the_aggregation(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a")], "id string, seq int, v string")
    consts = {"kind": F.lit("Group"), "flag": F.lit(False), "plan": F.lit(None).cast("double")}
    sets = [FieldSet("obj", ["v", "flag", "plan"]), FieldSet("arr", ["v", "kind"], array=True)]
    out = nest.nest_field_sets(df, ["id", "kind"], sets, ["seq"], constants=consts)
    assert out.columns == ["id", "kind", "arr", "obj", "copies"]
    row = out.first()
    assert row.kind == "Group" and row.obj.asDict() == {"flag": False, "plan": None, "v": "a"}
    assert [e.asDict() for e in row.arr] == [{"kind": "Group", "v": "a"}, {"kind": "Group", "v": "b"}]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Group" not in plan.split("Exchange")[1] if "Exchange" in plan else True  # not shuffled


def test_quality_report(spark):
    rows = [("a", "x", i) for i in range(5)] + [("b", "x", 0), ("c", None, 0), ("c", None, 1)]
    df = spark.createDataFrame(rows, "k1 string, k2 string, seq int")
    r = nest.quality_report(df, ["k1", "k2"]).first().asDict()
    assert r == {"staged_rows": 8, "null_key_rows": 2, "entities": 2, "entities_with_copies": 1,
                 "largest_entity_rows": 5}


def test_a6_list_endpoint_edge_bodies(spark):
    df = spark.createDataFrame([('[{"encodedKey":"k1","name":"A"}]',), ("[]",), (None,), ("not json",)], "body string")
    out = jsonio.dimension_from_json_array(df, "body", "encodedKey string, name string",
                                           {"encodedKey": "encodedKey", "name": "funder"})
    assert [tuple(r) for r in out.collect()] == [("k1", "A")]


def test_a6_bodies_that_are_no_json_are_listed(spark):
    df = spark.createDataFrame([(1, "[]"), (2, None), (3, "not json"), (4, '{"a":1,"a":2}')], "id int, body string")
    assert sorted(r.id for r in jsonio.unparsed_bodies(df, "body").collect()) == [3, 4]


def test_s18_arrays_in_arrays(spark):
    schema = "groupMembers array<struct<clientKey: string, roles: array<struct<groupRoleNameKey: string>>>>, m array<array<int>>"
    body = ('{"groupMembers":[{"clientKey":"a","roles":[{"groupRoleNameKey":"r1"}]},'
            '{"clientKey":"b","roles":[{"groupRoleNameKey":"r2"},{"groupRoleNameKey":"r3"}]}],"m":[[1],[2,3]]}')
    df = spark.createDataFrame([(body,), ('{"m":null}',)], "body string").select(F.from_json("body", schema).alias("j"))
    out = jsonio.flatten_json(df, "j")
    got = out.where("groupMembers_0_clientKey = 'a'").first().asDict()
    assert got["groupMembers_0_roles_0_groupRoleNameKey"] == "r1" and got["groupMembers_0_roles_1_groupRoleNameKey"] is None
    assert got["groupMembers_1_roles_1_groupRoleNameKey"] == "r3" and (got["m_0_0"], got["m_0_1"], got["m_1_1"]) == (1, None, 3)
    assert out.count() == 2


def test_s18_long_form_keeps_every_leaf(spark):
    deep = "1"
    for _ in range(10):
        deep = '{"k":' + deep + "}"
    rows_ = [(1, deep), (2, '{"notes":"[draft] call back","a":"[1,2]","p":"  padded  ","e":{},"f":[],"n":null}'),
             (3, '{"groupMembers":[{"roles":[{"groupRoleNameKey":"x"}]}]}'), (4, "broken {"), (5, None),
             (6, '{"q":"brace } in \\" text {[","t":true,"d":1.5}')]
    df = spark.createDataFrame(rows_, "seq int, body string")
    got = {(r.seq, r.path): r.value for r in jsonio.flatten_json_long(df, "seq", "body").collect()}
    assert got == {(1, "_".join("k" * 10)): "1", (2, "notes"): "[draft] call back", (2, "a"): "[1,2]",
                   (2, "p"): "  padded  ", (2, "e"): "{}", (2, "f"): "[]", (2, "n"): None,
                   (3, "groupMembers_0_roles_0_groupRoleNameKey"): "x",
                   (6, "q"): 'brace } in " text {[', (6, "t"): "true", (6, "d"): "1.5"}


def test_f8_like_names_with_special_characters(spark):
    details = spark.createDataFrame([("P\\a!b",), ("P\\abc",), ("P\\axc",), ("P\\",), ("P\\[x",), ("P\\1.5",), ("P\\1x5",),
                                     (None,)], "d string")
    names = spark.createDataFrame([("a!%",), ("a[bx]c",), (None,), ("a[^b]c",), ("[x",), ("1.5%",)], "name string")
    got = sorted(((r.d, r.name) for r in joins.like_join(details, "d", names, "P\\", "name").collect()), key=str)
    assert got == sorted([("P\\a!b", "a!%"), ("P\\abc", "a[bx]c"), ("P\\axc", "a[bx]c"), ("P\\", None),
                          ("P\\axc", "a[^b]c"), ("P\\[x", "[x"), ("P\\1.5", "1.5%")], key=str)


def test_j9_repeated_keys_and_null_values(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 1, 20), (1, 2, None), (2, 3, 5), (None, 4, 1), (None, 5, 1), (3, 6, None),
                                (3, 7, None)], "cust int, k int, price int")
    got = {r.k: (r.n, r.total) for r in joins.others_in_group(df, "cust", "k", "price", "n", "total").collect()}
    df.createOrReplaceTempView("j9")
    want = {r.k: (r.n, r.total) for r in spark.sql(
        "SELECT a.k, count(*) AS n, sum(b.price) AS total FROM j9 a JOIN j9 b ON a.cust = b.cust AND a.k <> b.k "
        "GROUP BY a.k, a.cust").collect()}
    assert got == want == {1: (2, None), 2: (2, 30), 6: (1, None), 7: (1, None)}


def test_row_sequence_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (5, 1), (5, 0), (1, 9)] * 1, "a int, b int")
    got = [(r.seq, r.a, r.b) for r in rows.row_sequence(df, ["a", "b"], "seq", buckets=3).orderBy("seq").collect()]
    assert got == [(0, None, 1), (1, None, 2), (2, 1, 9), (3, 5, 0), (4, 5, 1)]
    assert rows.row_sequence(df.where("false"), ["a", "b"]).count() == 0


def test_database_options():
    from bookshift.sources.tables import Split, jdbc_options
    assert jdbc_options("u", "t") == {"url": "u", "dbtable": "t"}
    assert jdbc_options("u", "t", "select 1") == {"url": "u", "query": "select 1"}
    split = jdbc_options("u", "t", "select * from t where id in (1)", Split("id", 1, 9, 4), {"user": "x"})
    assert split == {"url": "u", "user": "x", "dbtable": "(select * from t where id in (1)) q", "partitionColumn": "id",
                     "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
    with pytest.raises(ValueError):
        jdbc_options("u", "t", None, Split("id", None, 9))


def test_load_tables_routes(spark, tmp_path):
    from bookshift.sources.tables import load_tables
    spark.range(3).write.parquet(f"{tmp_path}/a.parquet")
    assert load_tables(spark, str(tmp_path), ["a"])["a"].count() == 3
    assert load_tables(spark, {"a": f"{tmp_path}/a.parquet"}, ["a"])["a"].count() == 3
