"""Query catalog: every operator of the build run on the driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB
SQL over the same tables) describe the same result; the checks compare them.
Nested results are compared through scalar projections (sizes, joined text,
first elements) because nested values print differently in the two engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookshift.functions import jsonio, scalars, temporal
from bookshift.operators import joins, nest, requests, rows
from bookshift.operators.nest import FieldSet
from bookshift.plans import datasets, documents, expected, flows, registry, specs, standins
from bookshift.plans.standins import table
from bookshift.sources import tables as sources

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


LSEQ = standins.lineitem_seq_cols()
AS_AT = "1998-06-30"
START_FROM = "1998-04-01"

# =============================================================================
# Sources, cohort filters
# =============================================================================


@query("scan_cohort_filter", """
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice
FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def q_scan_cohort_filter(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    o = sources.filter_cohort_ids(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return o.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


@query("cohort_semi_join", """
SELECT o_orderkey, o_custkey, o_totalprice
FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def q_cohort_semi_join(spark, sf):
    cohort = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("o_custkey"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sources.semi_join_cohort(o, cohort, "o_custkey")


# =============================================================================
# Filters (F2, F4, F5)
# =============================================================================


@query("filter_in_list", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity
FROM lineitem
WHERE l_returnflag IN ('R', 'A') AND l_linenumber IN (2, 3)
  AND l_quantity IN (1, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47)
""")
def q_filter_in_list(spark, sf):
    l = table(spark, sf, "lineitem")
    primes = [1.0, 3.0, 5.0, 7.0, 11.0, 13.0, 17.0, 19.0, 23.0, 29.0, 31.0, 37.0, 41.0, 43.0, 47.0]
    return (l.where(F.col("l_returnflag").isin("R", "A") & F.col("l_linenumber").isin(2, 3)
                    & F.col("l_quantity").isin(primes))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity"))


@query("snapshot_as_at", f"""
SELECT loan_id, loanstatus, startdate, enddate
FROM ({standins.LOAN_STATUS_SQL}) ls
WHERE TIMESTAMP '{AS_AT} 00:00:00' BETWEEN startdate AND enddate
  AND startdate >= TIMESTAMP '{START_FROM} 00:00:00'
""")
def q_snapshot_as_at(spark, sf):
    ls = standins.loan_status_report(spark, sf)
    as_at = F.lit(AS_AT).cast("date").cast("timestamp_ntz")
    return ls.where(as_at.between(F.col("startdate"), F.col("enddate"))
                    & (F.col("startdate") >= F.lit(START_FROM).cast("date").cast("timestamp_ntz")))


# =============================================================================
# Projections and constants
# =============================================================================


@query("project_rename", """
SELECT c_custkey AS id, c_name AS name, c_nationkey, c_mktsegment AS segment
FROM customer
""")
def q_project_rename(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    c = documents.rename_existing(c, {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment",
                                      "not_there": "ignored"})
    return c.drop("c_acctbal")


@query("constants", """
SELECT c_custkey, 'trial-1' AS test_group, 'Group' AS accountHolderType,
       false AS accrueInterestAfterMaturity, 0 AS gracePeriod, 1 AS repaymentPeriodCount,
       CAST(NULL AS DOUBLE) AS paymentPlan
FROM customer
""")
def q_constants(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey").withColumn("test_group", F.lit("trial-1"))
    picked = {k: specs.LOAN_DEFAULTS[k] for k in
              ["accountHolderType", "accrueInterestAfterMaturity", "gracePeriod", "repaymentPeriodCount",
               "paymentPlan"]}
    return documents.with_defaults(c, picked)


@query("row_sequence", """
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS seq, c_custkey, c_name
FROM customer
""")
def q_row_sequence(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return rows.row_sequence(c, ["c_custkey"], "seq", 0)


@query("entity_ids", """
SELECT DISTINCT o_custkey AS id FROM orders
""")
def q_entity_ids(spark, sf):
    return requests.entity_ids(table(spark, sf, "orders"), "o_custkey", distinct=True)


# =============================================================================
# Joins (J1-J17)
# =============================================================================


@query("join_inner_chain", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, c_name, n_name, r_name
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
""")
def q_join_inner_chain(spark, sf):
    l = table(spark, sf, "lineitem").select(*LSEQ)
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    # nation and region are fixed-size control tables (25 and 5 rows).
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    j = (l.join(o, o.o_orderkey == l.l_orderkey).join(c, c.c_custkey == o.o_custkey)
         .join(n, n.n_nationkey == c.c_nationkey).join(r, r.r_regionkey == n.n_regionkey))
    return j.select(*LSEQ, "o_custkey", "c_name", "n_name", "r_name")


@query("join_left", """
SELECT c_custkey, c_mktsegment, o_orderkey, o_orderstatus
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
""")
def q_join_left(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return c.join(o, o.o_custkey == c.c_custkey, "left").select("c_custkey", "c_mktsegment", "o_orderkey",
                                                                "o_orderstatus")


@query("multi_adhoc", """
SELECT c.c_custkey, COUNT(DISTINCT o.o_orderkey) AS count_of_pending
FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R'
WHERE c.c_mktsegment = 'BUILDING'
GROUP BY c.c_custkey
HAVING COUNT(DISTINCT o.o_orderkey) > 1
""")
def q_multi_adhoc(spark, sf):
    # K6 shape: keys LEFT JOIN tasks, inner join to the task type, count
    # distinct tasks per key, keep keys with more than one.
    c = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    l = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    j = c.join(o, o.o_custkey == c.c_custkey, "left").join(l, l.l_orderkey == o.o_orderkey)
    return (j.groupBy("c_custkey").agg(F.count_distinct("o_orderkey").alias("count_of_pending"))
            .where(F.col("count_of_pending") > 1))


_NULLSAFE_SIDES = """
WITH a AS (SELECT l_orderkey, NULLIF(l_discount, 0) AS disc, COUNT(*) AS n_a
           FROM lineitem GROUP BY l_orderkey, NULLIF(l_discount, 0)),
     b AS (SELECT l_orderkey, NULLIF(l_discount, 0) AS disc, MAX(l_extendedprice) AS max_price_b
           FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey, NULLIF(l_discount, 0))
"""


@query("merge_null_safe", _NULLSAFE_SIDES + """
SELECT a.l_orderkey, a.disc, a.n_a, b.max_price_b
FROM a JOIN b ON a.l_orderkey IS NOT DISTINCT FROM b.l_orderkey AND a.disc IS NOT DISTINCT FROM b.disc
""")
def q_merge_null_safe(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("disc", F.nullif(F.col("l_discount"), F.lit(0.0)))
    a = l.groupBy("l_orderkey", "disc").agg(F.count(F.lit(1)).alias("n_a"))
    b = l.where(F.col("l_linestatus") == "O").groupBy("l_orderkey", "disc") \
        .agg(F.max("l_extendedprice").alias("max_price_b"))
    return joins.merge_null_safe(a, b, ["l_orderkey", "disc"])


@query("merge_chain", """
WITH s AS (SELECT s_nationkey AS nationkey, COUNT(*) AS n_suppliers FROM supplier GROUP BY s_nationkey)
SELECT o.o_orderkey, c.c_custkey AS custkey, c.c_nationkey AS nationkey, n.n_name, s.n_suppliers
FROM orders o
JOIN customer c ON o.o_custkey IS NOT DISTINCT FROM c.c_custkey
JOIN nation n ON c.c_nationkey IS NOT DISTINCT FROM n.n_nationkey
JOIN s ON c.c_nationkey IS NOT DISTINCT FROM s.nationkey
""")
def q_merge_chain(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"),
                                            F.col("c_nationkey").alias("nationkey"))
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    s = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")) \
        .agg(F.count(F.lit(1)).alias("n_suppliers"))
    out = joins.merge_chain(o, [(c, ["custkey"]), (n, ["nationkey"]), (s, ["nationkey"])])
    return out.select("o_orderkey", "custkey", "nationkey", "n_name", "n_suppliers")


@query("join_role_playing", """
SELECT o.o_orderkey, l2.l_shipdate AS approved_date, l4.l_shipdate AS maturity_date
FROM orders o
JOIN lineitem l2 ON l2.l_orderkey = o.o_orderkey AND l2.l_linenumber = 2
JOIN lineitem l4 ON l4.l_orderkey = o.o_orderkey AND l4.l_linenumber = 4
""")
def q_join_role_playing(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    l = table(spark, sf, "lineitem")
    out = joins.role_join(o, "o_orderkey", l, "l_orderkey", "l_linenumber",
                          {"approved": 2, "maturity": 4}, {"l_shipdate": "date"})
    return out.select("o_orderkey", F.col("approved_date"), F.col("maturity_date"))


@query("join_existence", """
SELECT o.o_orderkey, l2.l_shipdate AS approved_date
FROM orders o
JOIN lineitem l2 ON l2.l_orderkey = o.o_orderkey AND l2.l_linenumber = 2
JOIN lineitem l6 ON l6.l_orderkey = o.o_orderkey AND l6.l_linenumber = 6
""")
def q_join_existence(spark, sf):
    # Line 6 is joined for its existence and multiplicity only (not a semi join).
    o = table(spark, sf, "orders").select("o_orderkey")
    l = table(spark, sf, "lineitem")
    out = joins.role_join(o, "o_orderkey", l, "l_orderkey", "l_linenumber",
                          {"approved": 2, "disbursed": 6}, {"l_shipdate": "date"})
    return out.select("o_orderkey", "approved_date")


_LIKE_NAMES = """
(SELECT DISTINCT o_orderpriority AS name FROM orders
 UNION
 SELECT DISTINCT substr(o_orderpriority, 1, 2) || '%' AS name FROM orders)
"""


@query("like_column_join", f"""
SELECT o.o_orderkey, r.name
FROM (SELECT o_orderkey, 'Rate\\' || o_orderpriority AS detail FROM orders) o
JOIN {_LIKE_NAMES} r ON o.detail LIKE 'Rate\\' || r.name ESCAPE '!'
""")
def q_like_column_join(spark, sf):
    o = table(spark, sf, "orders")
    rates = o.select("o_orderkey", F.concat(F.lit("Rate\\"), F.col("o_orderpriority")).alias("detail"))
    names = (o.select(F.col("o_orderpriority").alias("name"))
             .union(o.select(F.concat(F.substring("o_orderpriority", 1, 2), F.lit("%")).alias("name")))
             .distinct())
    matched = joins.like_join(rates.select("detail").distinct(), "detail", names, "Rate\\", "name")
    return rates.join(matched, "detail").select("o_orderkey", "name")


@query("self_join_residual", """
SELECT a.o_orderkey, a.o_custkey, COUNT(*) AS n_partners,
       CAST(SUM(CAST(b.o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS partner_total
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey
GROUP BY a.o_orderkey, a.o_custkey
""")
def q_self_join_residual(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                          F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    out = joins.others_in_group(o, "o_custkey", "o_orderkey", "price", "n_partners", "partner_total")
    return out.withColumn("partner_total", F.col("partner_total").cast("decimal(18,2)"))


@query("self_join_joint", f"""
WITH wl AS ({standins.APPLICATION_VIEW_SQL})
SELECT DISTINCT wl.loanid, wl.customerid AS pri_id, wlj.customerid AS sec_id
FROM wl JOIN wl wlj ON wlj.email = wl.jointapplicantemail
WHERE lower(wl.customerid) <> lower(wlj.customerid)
  AND wlj.customerid <> '' AND wlj.customerid <> '00000000-0000-0000-0000-000000000000'
  AND wl.isjointapplication = 1
""")
def q_self_join_joint(spark, sf):
    return datasets.joint_applicant_pairs(standins.application_view(spark, sf))


_COUNT_TRAN = f"""
SELECT l_orderkey, COUNT(DISTINCT l_partkey) AS count_of_tran
FROM lineitem WHERE l_shipdate < TIMESTAMP '{AS_AT} 00:00:00' GROUP BY l_orderkey
"""


def _count_tran(spark, sf):
    l = table(spark, sf, "lineitem").where(F.col("l_shipdate") < F.lit(AS_AT).cast("date").cast("timestamp_ntz"))
    return l.groupBy("l_orderkey").agg(F.count_distinct("l_partkey").alias("count_of_tran"))


@query("join_aggregate", f"""
SELECT o.o_orderkey, o.o_orderstatus, arm.count_of_tran
FROM orders o JOIN ({_COUNT_TRAN}) arm ON arm.l_orderkey = o.o_orderkey
""")
def q_join_aggregate(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    arm = _count_tran(spark, sf)
    return o.join(arm, arm.l_orderkey == o.o_orderkey).select("o_orderkey", "o_orderstatus", "count_of_tran")


@query("agg_count_distinct", """
SELECT l_returnflag, l_linestatus, COUNT(DISTINCT l_orderkey) AS n_orders, COUNT(DISTINCT l_partkey) AS n_parts
FROM lineitem GROUP BY 1, 2
""")
def q_agg_count_distinct(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.count_distinct("l_orderkey").alias("n_orders"),
                                                         F.count_distinct("l_partkey").alias("n_parts"))


@query("join_by_position", """
SELECT a.event_id AS seq, a.user_id AS id, a.event_type AS role_x, b.event_type AS role_y, b.props
FROM events a JOIN events b ON a.event_id = b.event_id
""")
def q_join_by_position(spark, sf):
    e = table(spark, sf, "events")
    left = e.select(F.col("event_id").alias("seq"), F.col("user_id").alias("id"), F.col("event_type").alias("role"))
    right = e.select(F.col("event_id").alias("seq"), F.col("event_type").alias("role"), "props")
    return joins.join_by_seq(left, right, "seq")


@query("lookup_strict", """
SELECT conv_id, turn,
       CASE lower(role) WHEN 'user' THEN 'role-key-user' WHEN 'assistant' THEN 'role-key-assistant'
                        WHEN 'system' THEN 'role-key-system' END AS role_key
FROM conversations
""")
def q_lookup_strict(spark, sf):
    m = {"user": "role-key-user", "assistant": "role-key-assistant", "system": "role-key-system"}
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", scalars.lookup("role", m, strict=True, lower=True, what="role")
                    .alias("role_key"))


@query("unmapped_codes", """
SELECT conv_id, turn, role FROM conversations WHERE lower(role) NOT IN ('user', 'assistant')
""")
def q_unmapped_codes(spark, sf):
    m = {"user": "role-key-user", "assistant": "role-key-assistant"}
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return scalars.unmapped_rows(c, "role", m, lower=True)


# =============================================================================
# Distinct, keep-first, top-N, unions
# =============================================================================


@query("distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, NULLIF(l_discount, 0) AS disc FROM lineitem
""")
def q_distinct_rows(spark, sf):
    l = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus",
                                            F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc"))
    return rows.distinct_rows(l)


@query("dedup_keep_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                   ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
WHERE rn = 1
""")
def q_dedup_keep_first(spark, sf):
    l = table(spark, sf, "lineitem").select(*LSEQ, "l_quantity")
    return rows.keep_first(l, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


_TOPN_BASE = f"""
SELECT o.o_orderstatus, o.o_orderkey, arm.count_of_tran, o.o_orderdate,
       row_number() OVER (PARTITION BY o.o_orderstatus
                          ORDER BY arm.count_of_tran ASC NULLS LAST, o.o_orderdate DESC NULLS FIRST,
                                   o.o_orderkey) AS loan_seq
FROM orders o JOIN ({_COUNT_TRAN}) arm ON arm.l_orderkey = o.o_orderkey
"""


@query("topn_per_group", f"SELECT * FROM ({_TOPN_BASE}) WHERE loan_seq <= 5")
def q_topn_per_group(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_orderdate")
    j = o.join(_count_tran(spark, sf), F.col("l_orderkey") == F.col("o_orderkey")) \
        .select("o_orderstatus", "o_orderkey", "count_of_tran", "o_orderdate")
    out = rows.top_n_per_group(j, ["o_orderstatus"],
                               [F.col("count_of_tran").asc_nulls_last(), F.col("o_orderdate").desc_nulls_first(),
                                F.col("o_orderkey").asc()], 5, "loan_seq")
    return out.withColumn("loan_seq", F.col("loan_seq").cast("bigint"))


@query("union_distinct", """
SELECT c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
UNION
SELECT s_nationkey AS nationkey, 'SUPPLIER' AS segment FROM supplier
""")
def q_union_distinct(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"),
                                            F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"),
                                            F.lit("SUPPLIER").alias("segment"))
    return c.union(s).distinct()


@query("union_all_tagged", """
SELECT 'urgent' AS branch, o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT 'low' AS branch, o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'
""")
def q_union_all_tagged(spark, sf):
    o = table(spark, sf, "orders")
    a = o.where(F.col("o_orderpriority") == "1-URGENT").select(F.lit("urgent").alias("branch"), "o_orderkey",
                                                               "o_totalprice")
    b = o.where(F.col("o_orderpriority") == "5-LOW").select(F.lit("low").alias("branch"), "o_orderkey",
                                                            "o_totalprice")
    return a.unionByName(b)


# =============================================================================
# Nesting (G7-G10, J15, Q1, Q4)
# =============================================================================

_NEST_ELEMS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       NULLIF(l_discount, 0) AS d, NULLIF(l_tax, 0) AS t
FROM lineitem
"""


def _nest_input(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.select(*LSEQ, F.nullif(F.col("l_discount"), F.lit(0.0)).alias("d"),
                    F.nullif(F.col("l_tax"), F.lit(0.0)).alias("t"))


def _pct(c):
    """A 2-decimal rate as whole hundredths, as text (same text in both engines)."""
    return F.round(c * 100).cast("int").cast("string")


@query("nest_object", f"""
WITH e AS ({_NEST_ELEMS}),
first AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                       ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM e)
SELECT l_orderkey,
       CASE WHEN d IS NULL AND t IS NULL THEN NULL ELSE CAST(ROUND(d * 100) AS INTEGER) END AS first_d,
       CASE WHEN d IS NULL AND t IS NULL THEN NULL ELSE CAST(ROUND(t * 100) AS INTEGER) END AS first_t,
       (d IS NULL AND t IS NULL) AS object_is_null
FROM first WHERE rn = 1
""")
def q_nest_object(spark, sf):
    out = nest.nest_object(_nest_input(spark, sf), ["l_orderkey"], "rates", ["d", "t"],
                           ["l_linenumber", "l_partkey", "l_suppkey"])
    return out.select("l_orderkey", F.round(F.col("rates.d") * 100).cast("int").alias("first_d"),
                      F.round(F.col("rates.t") * 100).cast("int").alias("first_t"),
                      F.col("rates").isNull().alias("object_is_null"))


_ARRAY_TEXT_SQL = """
CASE WHEN d IS NULL AND t IS NULL THEN 'null'
     ELSE COALESCE(CAST(CAST(ROUND(d * 100) AS INTEGER) AS VARCHAR), '~') || '/' ||
          COALESCE(CAST(CAST(ROUND(t * 100) AS INTEGER) AS VARCHAR), '~') END
"""


def _array_text(arr):
    def elem(x):
        return F.when(x.isNull(), F.lit("null")).otherwise(
            F.concat(F.coalesce(_pct(x.getField("d")), F.lit("~")), F.lit("/"),
                     F.coalesce(_pct(x.getField("t")), F.lit("~"))))
    return F.array_join(F.transform(arr, elem), ",")


@query("nest_array", f"""
WITH e AS ({_NEST_ELEMS}),
g AS (SELECT l_orderkey, COUNT(*) AS n, bool_and(d IS NULL AND t IS NULL) AS all_null,
             string_agg({_ARRAY_TEXT_SQL}, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS items
      FROM e GROUP BY l_orderkey)
SELECT l_orderkey,
       CAST(CASE WHEN n = 1 AND all_null THEN -1 ELSE n END AS BIGINT) AS n_elems,
       CASE WHEN n = 1 AND all_null THEN NULL ELSE items END AS items_text
FROM g
""")
def q_nest_array(spark, sf):
    out = nest.nest_array(_nest_input(spark, sf), ["l_orderkey"], "rates", ["d", "t"],
                          ["l_linenumber", "l_partkey", "l_suppkey"])
    return out.select("l_orderkey",
                      F.when(F.col("rates").isNull(), F.lit(-1)).otherwise(F.size("rates")).cast("bigint")
                      .alias("n_elems"),
                      _array_text(F.col("rates")).alias("items_text"))


@query("nest_field_sets", """
WITH e AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                        ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
SELECT l_orderkey,
       CAST(COUNT(*) AS BIGINT) AS n_lines,
       string_agg(CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR), ','
                  ORDER BY l_linenumber, l_partkey, l_suppkey) AS lines_text,
       max(CASE WHEN rn = 1 THEN l_returnflag || l_linestatus END) AS first_flags,
       COUNT(*) AS copies
FROM e GROUP BY l_orderkey
""")
def q_nest_field_sets(spark, sf):
    l = table(spark, sf, "lineitem")
    sets = [FieldSet("lines", ["l_linenumber", "l_partkey"], array=True),
            FieldSet("flags", ["l_returnflag", "l_linestatus"])]
    out = nest.nest_field_sets(l, ["l_orderkey"], sets, LSEQ[1:])
    text = F.array_join(F.transform("lines", lambda x: F.concat(x.getField("l_linenumber").cast("string"),
                                                               F.lit(":"),
                                                               x.getField("l_partkey").cast("string"))), ",")
    return out.select("l_orderkey", F.size("lines").cast("bigint").alias("n_lines"), text.alias("lines_text"),
                      F.concat("flags.l_returnflag", "flags.l_linestatus").alias("first_flags"), "copies")


@query("quarantine_null_keys", f"""
WITH e AS ({_NEST_ELEMS})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       concat_ws(',', CASE WHEN d IS NULL THEN 'd' END, CASE WHEN t IS NULL THEN 't' END) AS null_keys
FROM e WHERE d IS NULL OR t IS NULL
""")
def q_quarantine_null_keys(spark, sf):
    q = nest.quarantine_null_keys(_nest_input(spark, sf), ["d", "t"])
    return q.select(*LSEQ, "null_keys")


@query("duplicate_entities", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS staged_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) >= 2
""")
def q_duplicate_entities(spark, sf):
    return nest.duplicate_entities(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# =============================================================================
# Scalar functions
# =============================================================================


@query("scalar_casts", """
SELECT CAST(CAST(o_orderkey AS VARCHAR) AS INTEGER) AS loanid,
       CAST(o_custkey AS BIGINT) AS custkey,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
       CAST(o_orderkey AS VARCHAR) AS order_text
FROM orders
""")
def q_scalar_casts(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(scalars.to_int(F.col("o_orderkey").cast("string")).alias("loanid"),
                    scalars.to_bigint("o_custkey").alias("custkey"),
                    scalars.date_text(scalars.to_date("o_orderdate"), None).alias("order_day"),
                    F.col("o_orderkey").cast("string").alias("order_text"))


@query("scalar_strings", """
SELECT c_custkey,
       replace(c_name, '#', '-') AS name_dashed,
       replace(replace(c_name, '#', '-'), '-', '') AS id_text,
       replace(c_name, 'Customer', '') AS name_removed,
       '''' || CAST(c_custkey AS VARCHAR) || '''' AS quoted_id,
       lower(c_mktsegment) AS segment_lower,
       COALESCE(CAST(NULLIF(c_mktsegment, 'BUILDING') AS VARCHAR), '') || '/' || c_name AS tsql_concat
FROM customer
""")
def q_scalar_strings(spark, sf):
    c = table(spark, sf, "customer")
    dashed = scalars.replace_text("c_name", "#", "-")
    return c.select("c_custkey", dashed.alias("name_dashed"), scalars.strip_dashes(dashed).alias("id_text"),
                    scalars.remove_text("c_name", "Customer").alias("name_removed"),
                    scalars.quote_id("c_custkey").alias("quoted_id"),
                    F.lower("c_mktsegment").alias("segment_lower"),
                    scalars.concat_tsql(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("/"),
                                        F.col("c_name")).alias("tsql_concat"))


@query("scalar_conditionals", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'Monthly'
            WHEN o_orderpriority IN ('2-HIGH') THEN 'Fortnightly'
            WHEN o_orderpriority IN ('3-MEDIUM') THEN 'Weekly' END AS payment_frequency,
       CASE WHEN o_orderstatus = 'F' THEN 'Secured' ELSE 'Unsecured' END AS rate_type,
       CASE WHEN COALESCE(CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, 0) = 1
            THEN 'True' ELSE 'False' END AS is_secure
FROM orders
""")
def q_scalar_conditionals(spark, sf):
    o = table(spark, sf, "orders")
    secure = F.when(F.col("o_orderstatus") == "O", F.lit(None)).when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return o.select("o_orderkey",
                    scalars.case_in_lists("o_orderpriority", [(["1-URGENT", "5-LOW"], "Monthly"),
                                                              (["2-HIGH"], "Fortnightly"),
                                                              (["3-MEDIUM"], "Weekly")]).alias("payment_frequency"),
                    scalars.iff(F.col("o_orderstatus") == "F", "Secured", "Unsecured").alias("rate_type"),
                    scalars.iff(F.coalesce(secure, F.lit(0)) == 1, "True", "False").alias("is_secure"))


@query("scalar_dates", """
SELECT o_orderkey,
       o_orderdate + INTERVAL 1 MONTH AS first_repayment_date,
       o_orderdate + INTERVAL 1 MONTH + INTERVAL 30 DAY AS second_date,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 12 AS loan_term
FROM orders
""")
def q_scalar_dates(spark, sf):
    o = table(spark, sf, "orders")
    first = temporal.add_months_keep_time("o_orderdate", 1)
    return o.select("o_orderkey", first.alias("first_repayment_date"),
                    (first + F.expr("INTERVAL 30 DAYS")).alias("second_date"),
                    temporal.years_to_months(F.substring("o_orderpriority", 1, 1).cast("int")).alias("loan_term"))


_TZ_SQL = """
WITH d AS (SELECT DISTINCT o_orderdate AS ts FROM orders),
o AS (SELECT ts, CAST(epoch(ts) - epoch(timezone('Australia/Sydney', ts)) AS BIGINT) // 60 AS m FROM d)
SELECT ts,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN m < 0 THEN '-' ELSE '+' END ||
       lpad(CAST(abs(m) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs(m) % 60 AS VARCHAR), 2, '0') AS stamped
FROM o
"""


@query("tz_stamp", _TZ_SQL)
def q_tz_stamp(spark, sf):
    d = table(spark, sf, "orders").select(F.col("o_orderdate").alias("ts")).distinct()
    return d.select("ts", temporal.tz_stamp("ts").alias("stamped"))


@query("null_normalise", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULLIF(l_discount, 0) AS disc, l_tax
FROM lineitem
""")
def q_null_normalise(spark, sf):
    l = table(spark, sf, "lineitem")
    with_nan = l.select(*LSEQ, F.when(F.col("l_discount") == 0, F.lit(float("nan")))
                        .otherwise(F.col("l_discount")).alias("disc"), "l_tax")
    return scalars.normalise_nulls(with_nan)


# =============================================================================
# JSON, responses, request tables
# =============================================================================

_STATUS_SQL = ("CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 201 WHEN 'purchase' THEN 201 "
               "ELSE 200 END")
_REASON_SQL = ("CASE {c} WHEN 200 THEN 'OK' WHEN 201 THEN 'Created' WHEN 204 THEN 'No Content' "
               "WHEN 404 THEN 'Not Found' END")


def _responses(spark, sf):
    """Response table stand-in: one response per event; the event type gives the status code."""
    e = table(spark, sf, "events")
    code = (F.when(F.col("event_type") == "error", 404)
            .when(F.col("event_type").isin("signup", "purchase"), 201).otherwise(200))
    return e.select(F.col("event_id").cast("string").alias("request_id"), code.alias("status_code"),
                    F.col("props").alias("body"), "event_id", "user_id", "event_type")


@query("response_flatten", f"""
SELECT event_id AS seq, {_STATUS_SQL} AS status_code, CAST(json_extract(props, '$.k') AS BIGINT) AS body_k
FROM events
""")
def q_response_flatten(spark, sf):
    r = _responses(spark, sf).select(F.col("event_id").alias("seq"), "status_code",
                                     jsonio.parse_json_col("body", "k bigint").alias("body"))
    return jsonio.flatten_json(r, "body", keep=["seq", "status_code"], prefix=True)


@query("response_summary", f"""
SELECT CAST(event_id AS VARCHAR) AS request_id, {_REASON_SQL.format(c=_STATUS_SQL)} AS status,
       {_STATUS_SQL} AS status_code, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")
def q_response_summary(spark, sf):
    e = table(spark, sf, "events")
    reqs = requests.fetch_requests(e, "event_id")
    resp = _responses(spark, sf).select("request_id", "status_code", "body")
    return requests.response_summary(reqs, resp, body_schema="k bigint")


_ANSWER_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS request_id, {_REASON_SQL.format(c=_STATUS_SQL)} AS status,
       {_STATUS_SQL} AS status_code,
       CASE WHEN event_type <> 'error' THEN user_id END AS client_id,
       CASE WHEN event_type <> 'error' THEN 'key-' || CAST(event_id AS VARCHAR) END AS "encodedKey",
       CASE WHEN event_type = 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS "errors_0_errorCode",
       CASE WHEN event_type = 'error' THEN 'no "' || event_type || '"' END AS "errors_0_errorReason",
       CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN user_id END AS "errors_1_errorCode"
FROM events
"""


@query("response_summary_undeclared", _ANSWER_SQL)
def q_response_summary_undeclared(spark, sf):
    """Answers whose shapes are not declared: entities, or one or two errors."""
    resp = _responses(spark, sf)
    errors = F.to_json(F.struct(F.array_compact(F.array(
        F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("errorCode"),
                 F.concat(F.lit('no "'), "event_type", F.lit('"')).alias("errorReason")),
        F.when(F.col("user_id") % 2 == 0, F.struct(F.col("user_id").alias("errorCode"), F.lit(None).cast("string").alias("errorReason")))))
        .alias("errors")))
    entity = F.to_json(F.struct(F.concat(F.lit("key-"), F.col("event_id").cast("string")).alias("encodedKey"),
                                F.struct(F.col("user_id").alias("id")).alias("client")))
    body = F.when(F.col("event_type") == "error", errors).otherwise(entity)
    answers = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("request_id"), body.alias("body")).join(
        resp.select("request_id", "status_code"), "request_id")
    return requests.response_summary(requests.fetch_requests(table(spark, sf, "events"), "event_id"), answers, flatten=True)


@query("outcome_messages", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 404 ELSE 204 END AS status_code,
       CASE WHEN event_type = 'error' THEN CAST(event_id AS VARCHAR) || 'Not Found'
            ELSE 'Client ' || CAST(event_id AS VARCHAR) || ' is deleted' END AS message
FROM events
""")
def q_outcome_messages(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", 404).otherwise(204).alias("status_code"))
    return requests.outcome_messages(e, "event_id", "Client ", 204, " is deleted")


@query("json_flatten", """
SELECT event_id AS seq, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k, user_id AS meta_user,
       string_split(event_type, 'i')[1] AS meta_tags_0, string_split(event_type, 'i')[2] AS meta_tags_1
FROM events
""")
def q_json_flatten(spark, sf):
    e = table(spark, sf, "events")
    doc = F.struct(F.from_json("props", "k bigint").alias("props"),
                   F.struct(F.col("user_id").alias("user"), F.split("event_type", "i").alias("tags")).alias("meta"))
    text = e.select(F.col("event_id").alias("seq"), F.to_json(doc).alias("body"))
    schema = "props struct<k: bigint>, meta struct<user: bigint, tags: array<string>>"
    parsed = text.select("seq", jsonio.parse_json_col("body", schema).alias("body"))
    return jsonio.flatten_json(parsed, "body", keep=["seq"])


@query("json_parse", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k_struct,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k_variant
FROM events
""")
def q_json_parse(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", jsonio.parse_json_col("props", "k bigint").getField("k").alias("k_struct"),
                    F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k_variant"))


@query("dimension_from_json_array", """
SELECT 'e' || CAST(event_id AS VARCHAR) AS encodedKey, event_type AS funder FROM events
UNION ALL
SELECT 'u' || CAST(user_id AS VARCHAR) AS encodedKey, 'user' AS funder FROM events
""")
def q_dimension_from_json_array(spark, sf):
    e = table(spark, sf, "events")
    body = F.to_json(F.array(
        F.struct(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("encodedKey"),
                 F.col("event_type").alias("name")),
        F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("encodedKey"),
                 F.lit("user").alias("name"))))
    responses = e.select(body.alias("body"))
    return jsonio.dimension_from_json_array(responses, "body", "encodedKey string, name string",
                                            {"encodedKey": "encodedKey", "name": "funder"})


_CUSTOMER_PAYLOAD_SQL = """
'{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":"' || c_name || '","c_nationkey":' ||
CAST(c_nationkey AS VARCHAR) || COALESCE(',"segment":"' || NULLIF(c_mktsegment, 'BUILDING') || '"', '') || '}'
"""


def _customer_payloads(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey",
                                            F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return jsonio.payload_json(c, ["c_custkey"], "payload", exclude=[]).select("c_custkey", "payload")


@query("payload_json", f"SELECT c_custkey, {_CUSTOMER_PAYLOAD_SQL} AS payload FROM customer")
def q_payload_json(spark, sf):
    return _customer_payloads(spark, sf)


_BASE = requests.DEFAULT_BASE_URL


@query("requests_create", f"""
SELECT CAST(c_custkey AS VARCHAR) AS request_id, 'POST' AS method, '{_BASE}/clients/' AS url,
       {_CUSTOMER_PAYLOAD_SQL} AS body
FROM customer
""")
def q_requests_create(spark, sf):
    return requests.create_requests(_customer_payloads(spark, sf), "c_custkey", "payload",
                                    path=requests.CLIENTS_PATH)


@query("requests_delete", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS request_id, 'DELETE' AS method,
       '{_BASE}/loans/' || CAST(o_orderkey AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS body
FROM orders
""")
def q_requests_delete(spark, sf):
    return requests.delete_requests(table(spark, sf, "orders"), "o_orderkey", path=requests.LOANS_PATH)


@query("requests_state_change", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS request_id, 'POST' AS method,
       '{_BASE}/loans/' || CAST(o_orderkey AS VARCHAR) || ':changeState' AS url,
       '{requests.APPROVE_BODY}' AS body
FROM orders WHERE o_orderstatus = 'F'
""")
def q_requests_state_change(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    return requests.state_change_requests(o, "o_orderkey", requests.APPROVE_BODY)


@query("requests_fetch", f"""
SELECT CAST(c_custkey AS VARCHAR) AS request_id, 'GET' AS method,
       '{_BASE}/clients/' || CAST(c_custkey AS VARCHAR) || '?detailsLevel=Full&limit=1000' AS url,
       CAST(NULL AS VARCHAR) AS body
FROM customer
""")
def q_requests_fetch(spark, sf):
    return requests.fetch_requests(table(spark, sf, "customer"), "c_custkey")


# =============================================================================
# Named datasets K5-K11 on the loan-system stand-in tables
# =============================================================================

from bookshift.plans import loan_sources  # noqa: E402

_SYS = specs.DEFAULT_GUIDS["system_link"]


def _src(spark, sf, *names):
    return loan_sources.source_tables(spark, sf, list(names))


def _tz_sql(c: str) -> str:
    """DuckDB text of ``tz_stamp`` (Sydney offset from the instant difference)."""
    m = f"(CAST(epoch({c}) - epoch(timezone('Australia/Sydney', {c})) AS BIGINT) // 60)"
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN {m} < 0 THEN '-' ELSE '+' END || lpad(CAST(abs({m}) // 60 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST(abs({m}) % 60 AS VARCHAR), 2, '0') END")


K7_TABLES = registry.needs("client_details_operational")
K7_SQL = expected.BORROWERS
K7_COLS = ("loanid, firstname, middlename, surname, CAST(birthdate AS VARCHAR) AS birthdate, mobile, email, "
           "line1, city, region, country, postcode, veda_score, title")


@query("client_details_operational", f"WITH k7 AS ({K7_SQL})\n"
       f"SELECT {K7_COLS} FROM k7")
def q_client_details_operational(spark, sf):
    k7 = registry.build("client_details_operational", _src(spark, sf, *K7_TABLES))
    return k7.withColumn("birthdate", F.col("birthdate").cast("string"))


K8_TABLES = registry.needs("applicants_by_role")
K8_SQL = expected.APPLICANTS

@query("applicants_by_role", f"WITH k8 AS ({K8_SQL})\n"
       "SELECT customerid, id, CAST(birthdate AS VARCHAR) AS birthdate, loanid, application_role FROM k8")
def q_applicants_by_role(spark, sf):
    k8 = registry.build("applicants_by_role", _src(spark, sf, *K8_TABLES))
    return k8.withColumn("birthdate", F.col("birthdate").cast("string"))


K9_TABLES = registry.needs("loan_accounts_operational")
K9_SQL = expected.LOANS


@query("loan_accounts_operational", f"WITH k9 AS ({K9_SQL})\n"
       "SELECT * FROM k9")
def q_loan_accounts_operational(spark, sf):
    return registry.build("loan_accounts_operational", _src(spark, sf, *K9_TABLES))


@query("loan_accounts_blocks", f"WITH k9 AS ({K9_SQL})\n"
       "SELECT * FROM k9")
def q_loan_accounts_blocks(spark, sf):
    """K9 with every loan that has two rows of a kind laid out block by block."""
    return registry.build("loan_accounts_operational", _src(spark, sf, *K9_TABLES), block_rows=1)


K10_TABLES = registry.needs("loan_attributes")
K10_SQL = expected.ATTRIBUTES


@query("loan_attributes", f"WITH k10 AS ({K10_SQL})\nSELECT * FROM k10")
def q_loan_attributes(spark, sf):
    return registry.build("loan_attributes", _src(spark, sf, *K10_TABLES))


@query("named_query_cohort", f"WITH k10 AS ({K10_SQL})\n"
       "SELECT * FROM k10 WHERE loanid IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def q_named_query_cohort(spark, sf):
    cohort = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    name = "loan_attributes"
    return registry.with_cohort(name, _src(spark, sf, *registry.needs(name)), cohort)


K11_TABLES = registry.needs("disbursement_details")
K11_SQL = expected.FEES


@query("disbursement_details", f"WITH k11 AS ({K11_SQL})\nSELECT * FROM k11")
def q_disbursement_details(spark, sf):
    return registry.build("disbursement_details", _src(spark, sf, *K11_TABLES))


K6_TABLES = registry.needs("multi_adhoc")
K6_SQL = expected.SEVERAL_ONE_OFF


@query("multi_adhoc_repayment", f"WITH k6 AS ({K6_SQL})\nSELECT * FROM k6")
def q_multi_adhoc_repayment(spark, sf):
    return registry.build("multi_adhoc", _src(spark, sf, *K6_TABLES))


K5_TABLES = registry.needs("test_cohort")


_K5_SQL = expected.cohort(AS_AT, START_FROM)


@query("test_cohort", f"WITH k5 AS ({_K5_SQL})\nSELECT * FROM k5")
def q_test_cohort(spark, sf):
    k5 = registry.build("test_cohort", _src(spark, sf, *K5_TABLES), as_at=AS_AT, start_from=START_FROM)
    return k5.withColumn("startdate", F.col("startdate").cast("string")) \
        .withColumn("loan_seq", F.col("loan_seq").cast("bigint"))


# =============================================================================
# Documents K1-K4 and the request hand-over
# =============================================================================

def _size_or_minus1(c):
    return F.when(F.col(c).isNull(), F.lit(-1)).otherwise(F.size(c)).cast("bigint")


_FEE_CASE = ("CASE fee_type WHEN 'Establishment Fee' THEN 'fee-key-establishment' "
             "WHEN 'Transaction Fees' THEN 'fee-key-transaction' WHEN 'Brokerage Fee' THEN 'fee-key-brokerage' END")


def _disbursement_docs(spark, sf):
    k11 = registry.build("disbursement_details", _src(spark, sf, *K11_TABLES))
    return documents.disbursement_documents(k11, order_by=["predefinedFeeKey", "amount"])


_DISBURSEMENT_SQL = f"""WITH k11 AS ({K11_SQL}),
staged AS (SELECT loanid AS id, {_tz_sql('value_date')} AS valueDate, {_tz_sql('booking_date')} AS bookingDate,
                  {_tz_sql('first_repayment_date')} AS firstRepaymentDate, {_FEE_CASE} AS predefinedFeeKey, amount
           FROM k11),
docs AS (
SELECT id, CAST(1 AS BIGINT) AS copies,
       '{{"bookingDate":"' || bookingDate || '","fees":[' ||
       string_agg('{{"amount":' || CAST(amount AS VARCHAR) || ',"predefinedFeeKey":"' || predefinedFeeKey || '"}}', ','
                  ORDER BY predefinedFeeKey, amount) ||
       '],"firstRepaymentDate":"' || firstRepaymentDate || '","id":"' || id ||
       '","transactionDetails":{{"transactionChannelId":"settlement"}},"valueDate":"' || valueDate || '"}}' AS payload
FROM staged GROUP BY id, bookingDate, valueDate, firstRepaymentDate)
"""


@query("disbursement_payload", _DISBURSEMENT_SQL + "SELECT * FROM docs")
def disbursement_payloads(spark, sf):
    """Flagship output: one JSON document per disbursement."""
    return documents.payloads(_disbursement_docs(spark, sf))


@query("requests_disburse", _DISBURSEMENT_SQL + f"""
SELECT id AS request_id, 'POST' AS method, '{_BASE}/loans/' || id || '/disbursement-transactions' AS url, payload AS body
FROM docs
""")
def q_requests_disburse(spark, sf):
    return requests.disburse_requests(disbursement_payloads(spark, sf))


def _client_answers(spark, sf):
    """Answers to "read client" as (encodedKey, id)."""
    return jsonio.flatten_json(standins.client_answers(spark, sf).select(
        jsonio.parse_json_col("body", "encodedKey string, id string").alias("b")), "b")


_K1_TABLES = sorted(set(K7_TABLES + K8_TABLES))


def _client_staged(spark, sf):
    t = _src(spark, sf, *_K1_TABLES)
    return documents.client_staged(datasets.applicants_by_role(t), datasets.client_details_operational(t))


_CLIENT_STAGED_SQL = (f"""WITH k7 AS ({K7_SQL}), k8 AS ({K8_SQL}),
staged AS (SELECT k8.customerid, k8.id, k8.birthdate, k8.loanid, k8.application_role, k7.firstname,
                  k7.middlename, k7.surname, k7.mobile, k7.email, k7.line1, k7.city, k7.region, k7.country,
                  k7.postcode, k7.veda_score, k7.title
           FROM k8 JOIN k7 ON k8.loanid IS NOT DISTINCT FROM k7.loanid
                          AND k8.birthdate IS NOT DISTINCT FROM k7.birthdate)""")

_CLIENT_ADDRESS_JSON = ("'{\"city\":\"' || city || '\",\"country\":\"' || country || '\",\"line1\":\"' || line1 || "
                        "'\",\"postcode\":\"' || postcode || '\",\"region\":\"' || region || '\"}'")
_CLIENT_OBJECT_JSON = ("'{' || COALESCE('\"title\":\"' || title || '\",', '') || '\"veda_score\":' || "
                       "CAST(veda_score AS VARCHAR) || ',\"wisrcustomerid\":\"' || customerid || '\"}'")


@query("client_payload", _CLIENT_STAGED_SQL + f""",
m AS (SELECT id, firstname AS firstName, middlename AS middleName, surname AS lastName,
             COALESCE(CAST(birthdate AS VARCHAR), 'None') AS birthDate, mobile AS mobilePhone,
             email AS emailAddress, line1, city, region, postcode, country, veda_score, title, customerid,
             loanid, application_role FROM staged),
r AS (SELECT *, row_number() OVER (PARTITION BY id, firstName, middleName, lastName, birthDate, mobilePhone,
                                                emailAddress ORDER BY loanid, application_role) AS rn
      FROM m WHERE id IS NOT NULL AND firstName IS NOT NULL AND middleName IS NOT NULL AND lastName IS NOT NULL
               AND mobilePhone IS NOT NULL AND emailAddress IS NOT NULL)
SELECT id, CAST(COUNT(*) AS BIGINT) AS copies, CAST(COUNT(*) AS BIGINT) AS n_addresses,
       '{{"_Additional_Client_Details":' || max(CASE WHEN rn = 1 THEN {_CLIENT_OBJECT_JSON} END) ||
       ',"addresses":[' || string_agg({_CLIENT_ADDRESS_JSON}, ',' ORDER BY loanid, application_role) ||
       '],"birthDate":"' || birthDate || '","emailAddress":"' || emailAddress || '","firstName":"' || firstName ||
       '","id":"' || id || '","lastName":"' || lastName || '","middleName":"' || middleName ||
       '","mobilePhone":"' || mobilePhone || '"}}' AS payload
FROM r GROUP BY id, firstName, middleName, lastName, birthDate, mobilePhone, emailAddress
""")
def q_client_payload(spark, sf):
    docs = documents.client_documents(_client_staged(spark, sf), order_by=["loanid", "application_role"])
    body = F.struct(*[F.col(f"`{c}`") for c in sorted(c for c in docs.columns if c != "copies")])
    return docs.select("id", "copies", _size_or_minus1("addresses").alias("n_addresses"),
                       F.to_json(body, jsonio.JSON_OPTS).alias("payload"))


@query("group_payload", _CLIENT_STAGED_SQL + """
SELECT loanid AS id, CAST(COUNT(*) AS BIGINT) AS n_members,
       '{"groupName":' || CAST(loanid AS VARCHAR) || ',"id":' || CAST(loanid AS VARCHAR) || ',"groupMembers":[' ||
       string_agg('{"clientKey":"key-' || id || '","roles":[{"groupRoleNameKey":"' ||
                  CASE lower(application_role) WHEN 'primary' THEN 'role-key-primary'
                                               WHEN 'secondary' THEN 'role-key-secondary' END || '"}]}', ','
                  ORDER BY application_role, id) || ']}' AS payload
FROM staged WHERE loanid IS NOT NULL GROUP BY loanid
""")
def q_group_payload(spark, sf):
    # the answers to "read client" are an input of their own; they are attached by the id asked for
    clients = _client_staged(spark, sf).select("id", "loanid", "application_role").join(_client_answers(spark, sf), "id")
    return documents.group_payloads(documents.group_documents(clients, order_by=["application_role", "encodedKey"]))


_K3_TABLES = sorted(set(K9_TABLES + K10_TABLES))
_LOAN_ORDER = ["next_repayment_due_date", "repayment_amount", "recurring_repayment_day", "payment_frequency",
               "interestRate", "adhoc_repayment_date", "adhoc_repayment_amount", "account_name", "account_number",
               "account_bsb", "is_secure"]
_LOAN_ORDER_SQL = ", ".join(f"{c} ASC NULLS FIRST" for c in
                            ["next_due", "repayment_amount", "recurring_repayment_day", "payment_frequency",
                             "interest_rate", "adhoc_date", "adhoc_repayment_amount", "account_name",
                             "account_number", "account_bsb", "is_secure"])


def _funders(spark, sf):
    """Funder list answered per region as a JSON array, unpacked to (encodedKey, funder)."""
    n = table(spark, sf, "nation")
    body = F.to_json(F.collect_list(F.struct(F.concat(F.lit("branch-"), F.col("n_nationkey").cast("string"))
                                             .alias("encodedKey"), F.col("n_name").alias("name"))))
    responses = n.groupBy("n_regionkey").agg(body.alias("body"))
    return jsonio.dimension_from_json_array(responses, "body", "encodedKey string, name string",
                                            {"encodedKey": "encodedKey", "name": "funder"})


def _group_keys(spark, sf):
    """Group answers (GET /groups/<loan>) flattened to (accountHolderKey, loanid)."""
    o = table(spark, sf, "orders")
    answers = o.select(F.to_json(F.struct(F.concat(F.lit("grp-"), F.col("o_orderkey").cast("string"))
                                          .alias("encodedKey"),
                                          F.col("o_orderkey").cast("string").alias("id"))).alias("body"))
    flat = jsonio.flatten_json(answers.select(jsonio.parse_json_col("body", "encodedKey string, id string")
                                              .alias("b")), "b")
    return flat.select(F.col("encodedKey").alias("accountHolderKey"), F.col("id").cast("bigint").alias("loanid"))


def _loan_docs(spark, sf):
    t = _src(spark, sf, *_K3_TABLES)
    staged = documents.loan_staged(datasets.loan_accounts_operational(t), datasets.loan_attributes(t),
                                   _funders(spark, sf), _group_keys(spark, sf), "trial-1", by_loan=True)
    return documents.loan_documents(staged, order_by=_LOAN_ORDER)


def _json_sql(fields):
    """DuckDB text of a JSON object: ``name -> (sql, kind)``, kind t(ext), n(umber) or j(son); null fields are left out."""
    said = {"t": "'\"' || {0} || '\"'", "n": "CAST({0} AS VARCHAR)", "j": "{0}"}
    return "('{' || concat_ws(',', " + ", ".join(
        f"CASE WHEN {v} IS NOT NULL THEN '\"{k}\":' || {said[kind].format(v)} END"
        for k, (v, kind) in sorted(fields.items())) + ") || '}')"


def _constant_json(defaults, names):
    return {k: (f"'{jsonio_text(defaults[k])}'", "j") for k in names if defaults[k] is not None}


def jsonio_text(value):
    import json
    return json.dumps(value)


_REPAYMENT = {"next_repayment_due_date": ("next_due", "t"), "payment_frequency": ("payment_frequency", "t"),
              "recurring_repayment_day": ("recurring_repayment_day", "n"), "repayment_amount": ("repayment_amount", "n")}
_ADHOC = {"adhoc_repayment_amount": ("adhoc_repayment_amount", "n"), "adhoc_repayment_date": ("adhoc_date", "t")}
_BANK = {k: (k, "t") for k in ("account_bsb", "account_name", "account_number")}
_DETAILS = {k: (k, "t") for k in ("approved_date", "is_secure", "loan_purpose", "loan_status", "maturity_date",
                                  "rate_type")} | {"test_group": ("'trial-1'", "t")}
_SETS = {fs.name: fs for fs in specs.LOAN_FIELD_SETS}


def _settings(name, **own):
    constants = [f for f in _SETS[name].fields if f in specs.LOAN_DEFAULTS]
    return _json_sql({**_constant_json(specs.LOAN_DEFAULTS, constants), **own})


_FIRST = ["approved_date", "is_secure", "loan_purpose", "loan_status", "maturity_date", "rate_type", "interest_rate",
          "loan_term", "account_bsb", "account_name", "account_number"]
_LOAN_SQL = f"""WITH k9 AS ({K9_SQL}), k10 AS ({K10_SQL}),
staged AS (SELECT DISTINCT k9.*, k10.rate_type, k10.loan_purpose, k10.is_secure,
                  'branch-' || CAST(n_nationkey AS VARCHAR) AS branch, 'grp-' || CAST(k9.loanid AS VARCHAR) AS holder
           FROM k9 JOIN k10 ON k9.loanid = k10.loanid JOIN nation ON n_name = k9.funder),
s AS (SELECT * REPLACE ({_tz_sql('approved_date')} AS approved_date, {_tz_sql('maturity_date')} AS maturity_date),
             {_tz_sql('next_repayment_due_date')} AS next_due, {_tz_sql('adhoc_repayment_date')} AS adhoc_date FROM staged),
r AS (SELECT *, row_number() OVER (PARTITION BY loanid ORDER BY {_LOAN_ORDER_SQL}) AS rn,
             {_json_sql(_REPAYMENT)} AS repayment, {_json_sql(_ADHOC)} AS adhoc FROM s),
g AS (SELECT loanid, holder, branch, loan_amount, COUNT(*) AS copies,
             list(CASE WHEN repayment = '{{}}' THEN 'null' ELSE repayment END ORDER BY rn) AS repayments,
             list(CASE WHEN adhoc = '{{}}' THEN 'null' ELSE adhoc END ORDER BY rn) AS adhocs,
             {", ".join(f"max(CASE WHEN rn = 1 THEN {c} END) AS {c}" for c in _FIRST)}
      FROM r GROUP BY loanid, holder, branch, loan_amount),
parts AS (SELECT *, CASE WHEN repayments <> ['null'] THEN '[' || array_to_string(repayments, ',') || ']' END AS rep,
                 CASE WHEN adhocs <> ['null'] THEN '[' || array_to_string(adhocs, ',') || ']' END AS adh,
                 nullif({_json_sql(_BANK)}, '{{}}') AS bank, {_json_sql(_DETAILS)} AS details,
                 {_settings("interestSettings", interestRate=("interest_rate", "n"))} AS interest,
                 {_settings("redrawSettings")} AS redraw,
                 {_settings("scheduleSettings", repaymentInstallments=("loan_term", "n"))} AS schedule FROM g),
docs AS (SELECT loanid AS id, copies, {_json_sql({
    "_additional_loan_details": ("details", "j"), "_adhoc_repayment_details": ("adh", "j"),
    "_customer_bank_account_details": ("bank", "j"), "_repayment_details": ("rep", "j"),
    "accountHolderKey": ("holder", "t"), "accountHolderType": ("'Group'", "t"), "assignedBranchKey": ("branch", "t"),
    "id": ("loanid", "n"), "interestSettings": ("interest", "j"), "loanAmount": ("loan_amount", "n"),
    "productTypeKey": ("'product-key-placeholder'", "t"), "redrawSettings": ("redraw", "j"),
    "scheduleSettings": ("schedule", "j")})} AS payload FROM parts)
"""


@query("loan_payload", _LOAN_SQL + "SELECT * FROM docs")
def loan_payloads(spark, sf):
    return documents.payloads(_loan_docs(spark, sf))


# =============================================================================
# From a cohort to requests
# =============================================================================

_COHORT_SQL = "SELECT o_orderkey FROM orders"


def _cohort(spark, sf):
    """A caller's list of loan ids: every loan of the book."""
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("loanid"))


@query("loan_payload_cohort", _LOAN_SQL + f"SELECT * FROM docs WHERE id IN ({_COHORT_SQL})")
def q_loan_payload_cohort(spark, sf):
    staged = flows.loans(_src(spark, sf, *_K3_TABLES), _cohort(spark, sf), _funders(spark, sf), _group_keys(spark, sf),
                         "trial-1", by_loan=True)
    return documents.payloads(documents.loan_documents(staged, order_by=_LOAN_ORDER))


def _posts(sql, path, keep="true"):
    return (f"SELECT CAST(id AS VARCHAR) AS request_id, 'POST' AS method, '{_BASE}{path}' AS url, payload AS body "
            f"FROM ({sql}) WHERE {keep}")


@query("client_requests", _posts(ORACLE["client_payload"].replace(
    "FROM staged)", f"FROM staged WHERE loanid IN ({_COHORT_SQL}))"), "/clients/"))
def q_client_requests(spark, sf):
    staged = flows.clients(_src(spark, sf, *_K1_TABLES), _cohort(spark, sf))
    docs = documents.payloads(documents.client_documents(staged, order_by=["loanid", "application_role"]))
    return requests.create_requests(docs, "id")


@query("group_requests", _posts(ORACLE["group_payload"], "/groups", f"id IN ({_COHORT_SQL})"))
def q_group_requests(spark, sf):
    staged = flows.clients(_src(spark, sf, *_K1_TABLES), _cohort(spark, sf))
    clients = staged.select("id", "loanid", "application_role").join(_client_answers(spark, sf), "id")
    groups = documents.group_documents(clients, order_by=["application_role", "encodedKey"])
    return requests.create_requests(documents.group_payloads(groups), "id", path=requests.GROUPS_PATH)


@query("loan_requests", _posts(_LOAN_SQL + "SELECT * FROM docs", "/loans/"))
def q_loan_requests(spark, sf):
    return requests.create_requests(loan_payloads(spark, sf), "id", path=requests.LOANS_PATH)


@query("disbursement_requests", _DISBURSEMENT_SQL + f"""
SELECT id AS request_id, 'POST' AS method, '{_BASE}/loans/' || id || '/disbursement-transactions' AS url, payload AS body
FROM docs WHERE CAST(id AS BIGINT) IN ({_COHORT_SQL})
""")
def q_disbursement_requests(spark, sf):
    fees = flows.disbursements(_src(spark, sf, *K11_TABLES), _cohort(spark, sf))
    docs = documents.payloads(documents.disbursement_documents(fees, order_by=["predefinedFeeKey", "amount"]))
    return requests.disburse_requests(docs)


@query("disbursements_in_key_order", _DISBURSEMENT_SQL + "SELECT id, payload FROM docs ORDER BY id")
def q_disbursements_in_key_order(spark, sf):
    return requests.sink_order(disbursement_payloads(spark, sf).select("id", "payload"), "id")


@query("client_documents_expanded", "WITH d AS (" + ORACLE["client_payload"] + """)
SELECT id, payload FROM (SELECT id, payload, unnest(range(copies)) FROM d)
""")
def q_client_documents_expanded(spark, sf):
    return nest.expand_copies(q_client_payload(spark, sf)).select("id", "payload")


@query("fetch_result", f"""
SELECT row_number() OVER (ORDER BY c_custkey DESC) - 1 AS seq, 'c' || CAST(c_custkey AS VARCHAR) AS request_id,
       CASE WHEN c_custkey % 9 = 4 THEN NULL WHEN c_custkey % 9 = 5 THEN 404 ELSE 200 END AS status_code,
       CASE WHEN c_custkey % 9 NOT IN (4, 5) THEN 'key-c' || CAST(c_custkey AS VARCHAR) END AS encodedKey
FROM customer
""")
def q_fetch_result(spark, sf):
    asked = table(spark, sf, "customer").select((-F.col("c_custkey")).alias("o"),
                                                F.concat(F.lit("c"), F.col("c_custkey")).alias("request_id"))
    number = F.substring("request_id", 2, 20).cast("bigint") % 9
    answers = (standins.client_answers(spark, sf).where(number != 4)
               .withColumn("status_code", F.when(number == 5, 404).otherwise(F.col("status_code"))))
    asked = rows.row_sequence(asked, ["o"], "seq")
    return requests.fetch_result(asked, answers, "encodedKey string").select("seq", "request_id", "status_code", "encodedKey")


@query("requests_undo_approve", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS request_id, 'POST' AS method,
       '{_BASE}/loans/' || CAST(o_orderkey AS VARCHAR) || ':changeState' AS url,
       '{requests.UNDO_APPROVE_BODY}' AS body
FROM orders
""")
def q_requests_undo_approve(spark, sf):
    return requests.state_change_requests(table(spark, sf, "orders"), "o_orderkey", requests.UNDO_APPROVE_BODY)


@query("state_change_messages", f"""
SELECT CAST(event_id AS VARCHAR) AS request_id, {_STATUS_SQL} AS status_code,
       CASE WHEN {_STATUS_SQL} = 200 THEN 'Loan ' || CAST(event_id AS VARCHAR) || ' is approved'
            ELSE CAST(event_id AS VARCHAR) || {_REASON_SQL.format(c=_STATUS_SQL)} END AS message
FROM events
""")
def q_state_change_messages(spark, sf):
    return requests.outcome_messages(_responses(spark, sf), "request_id", "Loan ", 200, " is approved")


# =============================================================================
# Documents without collecting an entity
# =============================================================================

_LINE_SETS = [FieldSet("lines", ["l_linenumber", "l_partkey"], array=True),
              FieldSet("flags", ["l_returnflag", "l_linestatus"])]


@query("document_headers", """
SELECT l_orderkey, CAST(COUNT(*) AS BIGINT) AS copies,
       min_by(l_returnflag || l_linestatus, {'a': l_linenumber, 'b': l_partkey, 'c': l_suppkey}) AS first_flags
FROM lineitem GROUP BY l_orderkey
""")
def q_document_headers(spark, sf):
    d = nest.document_headers(table(spark, sf, "lineitem"), ["l_orderkey"], _LINE_SETS, LSEQ[1:])
    return d.select("l_orderkey", "copies", F.concat("flags.l_returnflag", "flags.l_linestatus").alias("first_flags"))


@query("document_elements", """
SELECT l_orderkey, 'lines' AS field_set, l_linenumber, l_partkey, l_suppkey,
       '{"l_linenumber":' || CAST(l_linenumber AS VARCHAR) || ',"l_partkey":' || CAST(l_partkey AS VARCHAR) || '}'
       AS element
FROM lineitem
""")
def q_document_elements(spark, sf):
    e = nest.document_elements(table(spark, sf, "lineitem"), ["l_orderkey"], _LINE_SETS, LSEQ[1:])
    return e.select("l_orderkey", "field_set", F.col("order.o0").alias("l_linenumber"),
                    F.col("order.o1").alias("l_partkey"), F.col("order.o2").alias("l_suppkey"), "element")


_CHUNK_BYTES = 64


@query("document_chunks", f"""
WITH e AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  '{{"l_linenumber":' || CAST(l_linenumber AS VARCHAR) || ',"l_partkey":' || CAST(l_partkey AS VARCHAR) || '}}' AS element
           FROM lineitem),
w AS (SELECT *, row_number() OVER o AS place, COUNT(*) OVER (PARTITION BY l_orderkey) AS n,
             CAST(floor(coalesce(sum(strlen(element) + 1) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                        / {_CHUNK_BYTES}) AS INTEGER) AS chunk
      FROM e WINDOW o AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey))
SELECT l_orderkey, 'lines' AS field_set, chunk, COUNT(*) AS n_elements,
       CASE WHEN min(place) = 1 THEN '[' ELSE ',' END || string_agg(element, ',' ORDER BY place)
       || CASE WHEN max(place) = max(n) THEN ']' ELSE '' END AS text
FROM w GROUP BY l_orderkey, chunk
""")
def q_document_chunks(spark, sf):
    return nest.document_chunks(table(spark, sf, "lineitem"), ["l_orderkey"], _LINE_SETS, LSEQ[1:], _CHUNK_BYTES)


# =============================================================================
# Failed reads, differing response shapes, lenient casts, auth text
# =============================================================================


@query("failed_responses", f"""
SELECT CAST(event_id AS VARCHAR) AS request_id, {_STATUS_SQL} AS status_code,
       {_REASON_SQL.format(c=_STATUS_SQL)} AS status, props AS body
FROM events WHERE {_STATUS_SQL} NOT IN (200, 201, 204)
""")
def q_failed_responses(spark, sf):
    _, failed = requests.split_responses(_responses(spark, sf).select("request_id", "status_code", "body"))
    return failed.select("request_id", "status_code", "status", "body")


@query("response_union", f"""
SELECT event_id AS seq, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS BIGINT) AS user_id
FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id AS seq, CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id
FROM events WHERE event_type <> 'click'
""")
def q_response_union(spark, sf):
    e = table(spark, sf, "events")
    clicks = jsonio.flatten_json(e.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("seq"), F.from_json("props", "k bigint").alias("b")), "b", keep=["seq"])
    views = jsonio.flatten_json(e.where(F.col("event_type") != "click").select(
        F.col("event_id").alias("seq"), F.from_json(F.concat(F.lit('{"user_id":'), F.col("user_id").cast("string"),
                                                             F.lit(',"k":'), F.get_json_object("props", "$.k"),
                                                             F.lit("}")), "k bigint, user_id bigint").alias("b")),
        "b", keep=["seq"])
    return requests.union_flattened(clicks, views)


@query("scalar_casts_lenient", """
SELECT c_custkey, TRY_CAST(c_name AS INTEGER) AS name_as_int, TRY_CAST(substr(c_name, 10) AS INTEGER) AS digits,
       CAST('1998-06-30T10:' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || ':00' AS TIMESTAMP) AS parsed
FROM customer
""")
def q_scalar_casts_lenient(spark, sf):
    c = table(spark, sf, "customer")
    iso = F.concat(F.lit("1998-06-30T10:"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit(":00"))
    return c.select("c_custkey", scalars.to_int("c_name", lenient=True).alias("name_as_int"),
                    scalars.to_int(F.substring("c_name", 10, 100), lenient=True).alias("digits"),
                    temporal.parse_iso(iso).alias("parsed"))


@query("scalar_base64", """
SELECT c_custkey, to_base64(encode(c_name || ':' || CAST(c_custkey AS VARCHAR))) AS auth
FROM customer
""")
def q_scalar_base64(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", scalars.basic_auth(F.col("c_name"), F.col("c_custkey").cast("string")).alias("auth"))


@query("json_flatten_long", """
SELECT event_id AS seq, 'p_k' AS path, CAST(json_extract(props, '$.k') AS VARCHAR) AS value FROM events
UNION ALL
SELECT event_id AS seq, 'tags_0' AS path, event_type AS value FROM events
UNION ALL
SELECT event_id AS seq, 'tags_1' AS path, CAST(user_id AS VARCHAR) AS value FROM events
""")
def q_json_flatten_long(spark, sf):
    e = table(spark, sf, "events")
    body = F.concat(F.lit('{"p":'), F.col("props"), F.lit(',"tags":["'), F.col("event_type"), F.lit('",'),
                    F.col("user_id").cast("string"), F.lit("]}"))
    return jsonio.flatten_json_long(e.select(F.col("event_id").alias("seq"), body.alias("body")), "seq", "body")


@query("client_match_audit", f"""WITH k7 AS ({K7_SQL}), k8 AS ({K8_SQL}),
a AS (SELECT loanid, birthdate, COUNT(*) AS applicant_rows FROM k8 GROUP BY loanid, birthdate),
b AS (SELECT loanid, birthdate, COUNT(*) AS borrower_rows FROM k7 GROUP BY loanid, birthdate)
SELECT a.loanid, CAST(a.birthdate AS VARCHAR) AS birthdate, a.applicant_rows, b.borrower_rows,
       a.applicant_rows * b.borrower_rows AS staged_rows
FROM a JOIN b ON a.loanid IS NOT DISTINCT FROM b.loanid AND a.birthdate IS NOT DISTINCT FROM b.birthdate
WHERE a.applicant_rows > 1 OR b.borrower_rows > 1
""")
def q_client_match_audit(spark, sf):
    t = _src(spark, sf, *_K1_TABLES)
    audit = datasets.client_match_audit(datasets.applicants_by_role(t), datasets.client_details_operational(t))
    return audit.withColumn("birthdate", F.col("birthdate").cast("string"))


@query("client_quality_report", _CLIENT_STAGED_SQL + """,
m AS (SELECT id, firstname AS firstName, middlename AS middleName, surname AS lastName,
             COALESCE(CAST(birthdate AS VARCHAR), 'None') AS birthDate, mobile AS mobilePhone,
             email AS emailAddress FROM staged),
per_key AS (SELECT COUNT(*) AS n,
                   (id IS NULL OR firstName IS NULL OR middleName IS NULL OR lastName IS NULL
                    OR birthDate IS NULL OR mobilePhone IS NULL OR emailAddress IS NULL) AS is_null
            FROM m GROUP BY id, firstName, middleName, lastName, birthDate, mobilePhone, emailAddress)
SELECT CAST(SUM(n) AS BIGINT) AS staged_rows,
       CAST(COALESCE(SUM(CASE WHEN is_null THEN n END), 0) AS BIGINT) AS null_key_rows,
       CAST(COUNT(CASE WHEN NOT is_null THEN 1 END) AS BIGINT) AS entities,
       CAST(COUNT(CASE WHEN NOT is_null AND n > 1 THEN 1 END) AS BIGINT) AS entities_with_copies,
       CAST(MAX(CASE WHEN NOT is_null THEN n END) AS BIGINT) AS largest_entity_rows
FROM per_key
""")
def q_client_quality_report(spark, sf):
    master = documents.client_master(_client_staged(spark, sf))
    return nest.quality_report(master, specs.CLIENT_KEYS)


@query("client_quarantine", _CLIENT_STAGED_SQL + """,
m AS (SELECT id, firstname AS firstName, middlename AS middleName, surname AS lastName,
             COALESCE(CAST(birthdate AS VARCHAR), 'None') AS birthDate, mobile AS mobilePhone,
             email AS emailAddress, loanid, application_role FROM staged)
SELECT id, loanid, application_role,
       concat_ws(',', CASE WHEN id IS NULL THEN 'id' END, CASE WHEN firstName IS NULL THEN 'firstName' END,
                 CASE WHEN middleName IS NULL THEN 'middleName' END, CASE WHEN lastName IS NULL THEN 'lastName' END,
                 CASE WHEN birthDate IS NULL THEN 'birthDate' END,
                 CASE WHEN mobilePhone IS NULL THEN 'mobilePhone' END,
                 CASE WHEN emailAddress IS NULL THEN 'emailAddress' END) AS null_keys
FROM m
WHERE id IS NULL OR firstName IS NULL OR middleName IS NULL OR lastName IS NULL OR birthDate IS NULL
   OR mobilePhone IS NULL OR emailAddress IS NULL
""")
def q_client_quarantine(spark, sf):
    q = documents.client_quarantine(_client_staged(spark, sf))
    return q.select("id", "loanid", "application_role", "null_keys")


# =============================================================================
# Result columns whose pandas form differs between the engines
# =============================================================================
# Spark hands timestamps to pandas in nanoseconds and DuckDB in microseconds;
# DuckDB turns DECIMAL into float64 where Spark gives Decimal objects, and
# nullable integers into pandas Int32/Int64 where Spark gives float64.  Equal
# values could then hash differently, so these result columns are cast the
# same way on both sides: timestamps to text (both engines print
# 'YYYY-MM-DD HH:MM:SS[.ffffff]'), exact decimals and nullable small integers
# to DOUBLE (no value changes).

RESULT_CASTS = {
    "snapshot_as_at": {"startdate": "string", "enddate": "string"},
    "join_role_playing": {"approved_date": "string", "maturity_date": "string"},
    "join_existence": {"approved_date": "string"},
    "topn_per_group": {"o_orderdate": "string"},
    "scalar_dates": {"first_repayment_date": "string", "second_date": "string"},
    "tz_stamp": {"ts": "string"},
    "loan_accounts_operational": {"approved_date": "string", "next_repayment_due_date": "string",
                                  "adhoc_repayment_date": "string", "maturity_date": "string",
                                  "recurring_repayment_day": "double"},
    "loan_accounts_blocks": {"approved_date": "string", "next_repayment_due_date": "string",
                             "adhoc_repayment_date": "string", "maturity_date": "string",
                             "recurring_repayment_day": "double"},
    "disbursement_details": {"value_date": "string", "booking_date": "string", "first_repayment_date": "string"},
    "scalar_casts_lenient": {"parsed": "string", "name_as_int": "double"},
    "self_join_residual": {"partner_total": "double"},
    "nest_object": {"first_d": "double", "first_t": "double"},
    "response_union": {"user_id": "double"},
    "response_summary_undeclared": {c: "double" for c in ("client_id", "errors_0_errorCode", "errors_1_errorCode")},
    "fetch_result": {"status_code": "double"},
}
_SQL_TYPE = {"string": "VARCHAR", "double": "DOUBLE"}


def _cast_columns(fn, casts):
    def run(spark, sf):
        return fn(spark, sf).withColumns({c: F.col(c).cast(t) for c, t in casts.items()})
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


for _name, _casts in RESULT_CASTS.items():
    QUERIES[_name] = _cast_columns(QUERIES[_name], _casts)
    ORACLE[_name] = ("SELECT * REPLACE (" + ", ".join(f'CAST("{c}" AS {_SQL_TYPE[t]}) AS "{c}"'
                                                     for c, t in _casts.items()) + ")\n"
                     f"FROM (\n{ORACLE[_name]}\n) AS _q")
