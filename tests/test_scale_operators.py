"""Operators that must hold when one key, value or entity is very large: wide
and long flatten, LIKE by q-grams, composite ranges, side-by-side products,
spread joins, chunked documents, counted writes, split reads, named datasets."""

import json
import random

import pytest
from pyspark.sql import functions as F

from bookshift.functions import jsonio
from bookshift.operators import joins, nest, product, rows
from bookshift.operators import requests as rq
from bookshift.operators.nest import FieldSet
from bookshift.plans import datasets, documents, registry
from bookshift.sources import tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sizes(df, column="__n"):
    """Rows of every partition that has any."""
    return sorted(r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect())


@pytest.fixture
def no_aqe(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.shuffle.partitions")}
    for k, v in zip(kept, ("false", "-1", "16")):
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def flat(value, path=()):
    """Flatten as plain Python."""
    if isinstance(value, (dict, list)) and value:
        pairs = value.items() if isinstance(value, dict) else enumerate(value)
        return [leaf for k, v in pairs for leaf in flat(v, (*path, str(k)))]
    return [("_".join(path), value)]


def some_json(rng, depth):
    kind = rng.choice("saoonb") if depth else rng.choice("snb")
    if kind == "o":
        return {rng.choice(["a", "b c", "d\"e", "é", "f\\", ""]) + str(k): some_json(rng, depth - 1) for k in range(rng.randint(0, 4))}
    if kind == "a":
        return [some_json(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return {"s": rng.choice(["", "x", "q\"[{,:", "line\nfeed\\", "éø", "12", "null"]), "n": rng.randint(-9, 10**6),
            "b": rng.choice([True, False, None])}[kind]


def test_s18_long_form_against_plain_flatten(spark):
    rng = random.Random(3)
    bodies = [some_json(rng, 5) for _ in range(150)]
    texts = [json.dumps(b, ensure_ascii=k % 2 == 0, indent=2 if k % 3 == 0 else None) for k, b in enumerate(bodies)]
    df = spark.createDataFrame(list(enumerate(texts)), "seq int, body string")
    got = {}
    for r in jsonio.flatten_json_long(df, "seq", "body").collect():
        got.setdefault(r.seq, []).append((r.path, r.value))
    say = lambda v: v if isinstance(v, str) else None if v is None else json.dumps(v)
    for k, body in enumerate(bodies):
        assert sorted(got.get(k, []), key=str) == sorted(((p, say(v)) for p, v in flat(body)), key=str)


def test_s18_long_form_of_deep_and_wide_bodies(spark):
    deep = "1"
    for k in range(1000):
        deep = '{"k":' + deep + "}" if k % 2 else "[" + deep + "]"
    wide = json.dumps({"v": list(range(5000)), "t": "\\\"" * 9000})
    df = spark.createDataFrame([(1, deep), (2, wide)], "seq int, body string")
    out = jsonio.flatten_json_long(df, "seq", "body")
    got = out.collect()
    assert [(r.path.count("_"), r.value) for r in got if r.seq == 1] == [(999, "1")]
    assert len([r for r in got if r.seq == 2]) == 5001
    shallow = jsonio.flatten_json_long(spark.createDataFrame([(1, "{}")], "seq int, body string"), "seq", "body")
    assert _plan(out).count("\n") == _plan(shallow).count("\n")  # the plan does not grow with the bodies


def test_a13_summary_of_undeclared_answers(spark):
    reqs = spark.createDataFrame([(str(k), "POST", "u", None) for k in range(1, 6)],
                                 "request_id string, method string, url string, body string")
    answers = spark.createDataFrame([
        ("1", 201, '{"encodedKey":"k1","n":7,"rate":1}'), ("2", 400, '{"errors":[{"errorCode":4},{"errorCode":9,"errorReason":"x y"}]}'),
        ("3", 201, '{"encodedKey":8,"rate":2.5,"flags":[true],"none":null}'), ("4", 500, "<html>")],
        "request_id string, status_code int, body string")
    out = rq.response_summary(reqs, answers, flatten=True)
    assert dict(out.dtypes) == {
        "request_id": "string", "status": "string", "status_code": "int", "encodedKey": "string", "errors_0_errorCode": "bigint",
        "errors_1_errorCode": "bigint", "errors_1_errorReason": "string", "flags_0": "boolean", "n": "bigint", "none": "string",
        "rate": "double"}
    got = {r.request_id: r for r in out.collect()}
    assert (got["2"].status, got["2"].errors_0_errorCode, got["2"].errors_1_errorCode, got["2"].errors_1_errorReason) == (
        "Bad Request", 4, 9, "x y")
    assert (got["1"].encodedKey, got["3"].encodedKey, got["1"].rate, got["3"].rate, got["3"].flags_0) == ("k1", "8", 1.0, 2.5, True)
    assert got["4"].encodedKey is None and got["5"].status is None
    with pytest.raises(ValueError, match="clash"):
        rq.response_summary(reqs, answers.withColumn("body", F.lit('{"status":1}')), flatten=True)
    both = rq.response_summary(reqs, answers.withColumn("body", F.lit('{"status":1}')), flatten=True, prefix="body_")
    assert both.where("status_code = 201").first().body_status == 1
    given = jsonio.flatten_undeclared(answers, "body", ["request_id"], columns={"n": "bigint"})
    assert given.columns == ["request_id", "n"] and given.count() == 4


def like_brute(texts, names, prefix):
    import re

    def regex(name):
        out, k = re.escape(prefix), 0
        while k < len(name):
            close = name.find("]", k + 2)
            if name[k] == "[" and close > 0:
                out, k = out + name[k:close + 1], close
            else:
                out += {"%": ".*", "_": "."}.get(name[k], re.escape(name[k]))
            k += 1
        return re.compile(out + r"\Z", re.S)
    return sorted((t, n or "") for n in names for t in texts if t is not None and regex(n or "").match(t))


def test_f8_like_against_plain_matching(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abé") for _ in range(n))
    for prefix in ("", "P\\", "Pre%"):
        texts = [prefix * (k % 9 > 0) + word(rng.randint(0, 6)) for k in range(120)] + [None, "", prefix]
        names = ["".join(rng.choice(["a", "b", "é", "%", "_", "[ab]", "[^a]", word(3)]) for _ in range(rng.randint(0, 4)))
                 for _ in range(60)] + [None, "%", "", "_", "%b", "[x"]
        texts, names = sorted(set(texts), key=str), sorted(set(names), key=str)
        got = joins.like_join(spark.createDataFrame([(t,) for t in texts], "d string"), "d",
                              spark.createDataFrame([(n,) for n in names], "name string"), prefix, "name").collect()
        # a null and an empty name are two rows that read alike
        assert sorted((r.d, r.name or "") for r in got) == like_brute(texts, names, prefix)


def test_f8_leading_wildcards_at_size(spark):
    said = F.substring(F.sha1(F.col("id").cast("string")), 1, 14)
    texts = spark.range(100_000).select(F.concat(F.lit("Rate\\"), said).alias("d"), "id")
    names = spark.range(100_000).select(F.concat(F.lit("%"), F.substring(said, 3, 12)).alias("name"), F.col("id").alias("of"))
    out = joins.like_join(texts, "d", names, "Rate\\", "name")
    assert out.agg(F.count_if(F.expr("id = of")), F.count(F.lit(1))).first() == (100_000, 100_000)
    plan = _plan(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_w3_half_the_rows_share_the_leading_value(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.sha1(F.col("id").cast("string"))).alias("a"),
                                    F.when(F.col("id") % 5 > 0, F.expr("timestamp_ntz'2020-03-08 02:30:00' + make_dt_interval(0, id % 7)")).alias("t"),
                                    (F.col("id") * 7919 % 40_000).cast("decimal(12,2)").alias("c"))
    order = ["a", "t", "c"]
    out = rows.row_sequence(df, order, "seq", start=3, buckets=16)
    got = out.collect()
    want = df.orderBy(*order).collect()
    assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r.seq)] == [tuple(r) for r in want]
    assert sorted(r.seq for r in got) == list(range(3, 40_003))
    sizes = _sizes(out)
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    assert rows.row_sequence(df.where("false"), order).count() == 0
    assert [r.seq for r in rows.row_sequence(df.limit(1), order, start=9).collect()] == [9]


def test_k9_sides_of_a_large_key_are_spread(spark, no_aqe):
    big = spark.range(100_000).select(F.lit("big").alias("code"), F.when(F.col("id") < 3, 1).otherwise(2).alias("kind"), "id")
    small = spark.createDataFrame([("s", 1, 1), ("s", 1, 1), ("s", 2, 5), ("s", 3, 6), ("t", 3, 7), ("u", 9, 0), (None, 1, 4)],
                                  "code string, kind int, id long")
    df = big.unionByName(small)
    side = lambda k, name: (F.col("kind") == k, F.struct(F.col("id").alias(name)))
    pairs = (F.col("kind") == 3, F.array(F.struct(F.col("id").alias("z")), F.struct((F.col("id") * 10).alias("z"))))
    sides = {"one": side(1, "x"), "two": side(2, "y"), "three": pairs}
    out = product.beside(df, "code", sides, outer=True, block_rows=1000)
    assert out.columns == ["code", "x", "y", "z"]
    got = sorted((tuple(r) for r in out.where("code is distinct from 'big'").collect()), key=str)
    assert got == sorted([("s", 1, 5, 6), ("s", 1, 5, 60), ("s", 1, 5, 6), ("s", 1, 5, 60), ("t", None, None, 7), ("t", None, None, 70),
                          ("u", None, None, None), (None, 4, None, None)], key=str)
    large = out.where("code = 'big'").groupBy("x", F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.count("z").alias("z")).collect()
    for x in (0, 1, 2):
        mine = [r for r in large if r.x == x]
        assert (sum(r.n for r in mine), sum(r.y for r in mine), sum(r.z for r in mine)) == (99_997, sum(range(3, 100_000)), 0)
    sizes = sorted(sum(r.n for r in large if r.p == p) for p in {r.p for r in large})
    assert len(sizes) == 16 and sizes[-1] < 3 * sizes[8]
    inner = product.beside(df, "code", {k: sides[k] for k in ("one", "two")}, outer=False, block_rows=2)
    assert {r.code: r.n for r in inner.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()} == {"s": 2, "big": 3 * 99_997}


def test_k9_small_blocks_give_the_same_rows(spark):
    rng = random.Random(8)
    data = [(rng.choice("aaaab"), rng.choice([1, 2, 3]), rng.randint(0, 9)) for _ in range(60)]
    df = spark.createDataFrame(data, "code string, kind int, v int")
    sides = {f"s{k}": (F.col("kind") == k, F.struct(F.col("v").alias(f"v{k}"))) for k in (1, 2, 3)}
    whole = sorted(tuple(r) for r in product.beside(df, "code", sides, outer=True).collect())
    cut = sorted(tuple(r) for r in product.beside(df, "code", sides, outer=True, block_rows=3).collect())
    direct = sorted((c, x, y, z) for c in "ab" for k, x in [(a[0], a[2]) for a in data if a[1] == 1] if k == c
                    for m, y in [(a[0], a[2]) for a in data if a[1] == 2] if m == c
                    for n, z in [(a[0], a[2]) for a in data if a[1] == 3] if n == c)
    assert whole == cut == direct


@pytest.mark.parametrize("hot_side", ["left", "right", "both"])
def test_j4_a_third_of_the_rows_without_a_key(spark, no_aqe, hot_side):
    def side(name, n, hot):
        key = F.when((F.col("id") % 3 == 0) & F.lit(hot), F.lit(None)).otherwise(F.col("id"))
        return spark.range(n).select(key.cast("long").alias("k"), F.lit(None).cast("string").alias("j"), F.col("id").alias(name))

    left = side("l", 12_000 if hot_side != "right" else 300, hot_side != "right")
    right = side("r", 12_000 if hot_side == "right" else 300, hot_side == "right")
    if hot_side == "both":
        right = right.unionByName(right.limit(2).withColumn("k", F.lit(None).cast("long")))
    else:
        thin = right if hot_side == "left" else left
        extra = thin.limit(1).withColumn("k", F.lit(None).cast("long"))
        right, left = (right.unionByName(extra), left) if hot_side == "left" else (right, left.unionByName(extra))
    plain = joins.merge_null_safe(left, right, ["k", "j"])
    spread = joins.merge_null_safe(left, right, ["k", "j"], spread_hot=True)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).count() == 0 and spread.count() == plain.count() >= 4000
    sizes = _sizes(spread.where("k is null"))
    assert len(sizes) == 16 and sizes[-1] < 3 * sizes[len(sizes) // 2]
    outer = joins.merge_null_safe(left, right, ["k", "j"], "left", spread_hot=True)
    assert outer.exceptAll(joins.merge_null_safe(left, right, ["k", "j"], "left")).count() == 0
    with pytest.raises(ValueError):
        joins.merge_null_safe(left, right, ["k"], "full", spread_hot=True)


def test_j10_one_email_of_many_loans(spark, no_aqe):
    wl = spark.range(6000).select(
        F.col("id").alias("loanid"), F.concat(F.lit("C"), F.col("id") % 50).alias("customerid"),
        F.when(F.col("id") % 3 == 0, F.lit("shared@x")).otherwise(F.concat("id", F.lit("@x"))).alias("email"),
        F.when(F.col("id") % 3 == 1, F.lit("shared@x")).otherwise(F.concat(F.col("id") + 1, F.lit("@x"))).alias("jointapplicantemail"),
        F.lit(1).alias("isjointapplication"))
    out = datasets.joint_applicant_pairs(wl, spread_hot=True)
    plain = datasets.joint_applicant_pairs(wl)
    assert out.count() == plain.count() > 90_000 and out.exceptAll(plain).count() == 0


def test_g8_chunks_concatenate_to_the_array(spark):
    big = spark.range(3000).select(F.lit("big").alias("id"), F.lit("K").alias("kind"), F.col("id").alias("seq"),
                                   F.when(F.col("id") % 7 > 0, F.repeat(F.lit("é"), (F.col("id") % 40).cast("int"))).alias("v"))
    more = spark.createDataFrame([("a", "K", 2, "x"), ("a", "K", 1, None), ("b", "K", 1, None), ("c", "K", 1, "nan"), ("c", "K", 2, "nan"),
                                  (None, "K", 1, "lost"), ("d", "K", 1, "x" * 900)], "id string, kind string, seq long, v string")
    df = big.unionByName(more)
    sets = [FieldSet("all", ["seq", "v"], array=True), FieldSet("texts", ["v"], array=True),
            FieldSet("raw", ["v"], array=True, prune=False), FieldSet("head", ["v"])]
    whole = {}
    nested = nest.nest_field_sets(df, ["id"], sets, ["seq"])
    for r in nested.select("id", *[F.to_json(s, {"ignoreNullFields": "true"}).alias(s) for s in ("all", "texts", "raw")]).collect():
        whole |= {(r.id, s): r[s] for s in ("all", "texts", "raw") if r[s] is not None}
    chunks = nest.document_chunks(df, ["id"], sets, ["seq"], budget=500, ranges=8)
    got, sizes = {}, []
    for r in sorted(chunks.collect(), key=lambda r: (r.id, r.field_set, r.chunk)):
        got[r.id, r.field_set] = got.get((r.id, r.field_set), "") + r.text
        sizes.append((r.id, len(r.text.encode())))
    assert got == whole
    assert max(n for i, n in sizes if i == "big") < 500 + 200 and sum(i == "big" for i, _ in sizes) > 100


def test_q1_counts_ride_along_with_the_documents(spark):
    staged = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", 1, "x"), (None, 1, "z"), (None, 2, "z")], "id string, seq int, v string")
    docs, said = nest.nest_counted(staged, ["id"], [FieldSet("vs", ["v"], array=True)], ["seq"])
    assert sorted(r.id for r in docs.collect()) == ["a", "b"]
    assert said.counts() == nest.quality_report(staged, ["id"]).first().asDict()


def test_client_documents_with_counts(spark):
    from bookshift.plans import specs
    from bookshift.plans.catalog import _client_staged

    staged = _client_staged(spark, "/root/testdata/sf0.001")
    docs, said = documents.client_documents_counted(staged, ["loanid", "application_role"])
    plain = documents.client_documents(staged, ["loanid", "application_role"])
    assert docs.columns == plain.columns and len(docs.collect()) == plain.count()
    assert said.counts() == nest.quality_report(documents.client_master(staged), specs.CLIENT_KEYS).first().asDict()


def test_a1_predicates_cover_every_key_once(spark):
    ids = [7] * 400 + list(range(1000, 1400)) + [10**12, -5, None, 7]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    cuts = tables.key_cuts(df, "k", 8)
    counts = [df.where(p).count() for p in tables.range_predicates("k", cuts)]
    assert sum(counts) == len(ids) and sorted(counts)[-1] == 401 and sorted(counts)[-2] <= 102
    assert sum(df.where(p).count() for p in tables.range_predicates("k", [])) == len(ids)
    even = spark.range(9000).select((F.col("id") * F.col("id")).alias("k"))  # ids ever further apart
    sizes = [even.where(p).count() for p in tables.range_predicates("k", tables.key_cuts(even, "k", 9))]
    assert len(sizes) == 9 and sum(sizes) == 9000 and max(sizes) < 1.1 * min(sizes)
    assert tables.key_cuts(df.where("false"), "k", 8) == []


def test_a3_cohort_ranges_leave_gaps_unread(spark):
    cohort = spark.createDataFrame([(i,) for i in [*range(0, 50), *range(100_000, 100_050), None, 3]], "loanid long")
    table = spark.range(0, 200_000).withColumnRenamed("id", "k")
    asked = tables.cohort_predicates(cohort, "loanid", "k", 4)
    read = [table.where(p) for p in asked]
    assert sum(p.count() for p in read) == 100
    kept = read[0]
    for p in read[1:]:
        kept = kept.unionByName(p)
    assert kept.join(cohort, kept.k == cohort.loanid, "left_semi").count() == 100
    assert tables.cohort_predicates(cohort.where("false"), "loanid", "k", 4) == ["1 = 0"]
    assert tables.cohort_predicates(cohort.where("loanid = 3"), "loanid", "k", 4) == ["k = 3"]
    with pytest.raises(ValueError):
        tables.read_jdbc(spark, "jdbc:x", "t", split=tables.Split("k", 1, 2), predicates=["1 = 0"])


def test_a4_named_datasets(spark):
    assert "loan_attributes" in registry.names() and registry.needs("loan_attributes") == ("application_loans", "application_security")
    loans = spark.createDataFrame([(1, 1, "car"), (2, 0, "home")], "loanid int, issecuredrateloan int, loanpurpose string")
    secure = spark.createDataFrame([(1, 1)], "loanid int, issecureloan int")
    t = {"application_loans": loans, "application_security": secure}
    assert registry.build("loan_attributes", t).collect() == datasets.loan_attributes(t).collect()
    assert [r.loanid for r in registry.with_cohort("loan_attributes", t, [2]).collect()] == [2]
    ids = spark.createDataFrame([("1",), ("1",), ("9",)], "any string")
    assert [r.loanid for r in registry.with_cohort("loan_attributes", t, ids).collect()] == [1]
    assert registry.with_cohort("loan_attributes", t, []).count() == 0
    with pytest.raises(KeyError, match="no dataset"):
        registry.build("nothing", t)
    with pytest.raises(KeyError, match="application_security"):
        registry.build("loan_attributes", {"application_loans": loans})
    for name in registry.names():  # the tables named are the tables read
        from bookshift.plans.loan_sources import source_tables
        registry.build(name, source_tables(spark, "/root/testdata/sf0.001", list(registry.needs(name))))
