"""Stand-in source frames built from the driver's TPC-H-style tables.

The checks run the library's operators on the driver tables.  These helpers
give those tables the shape of the loan sources (see FIXTURES.md section 7):

* application view  <- orders joined to customer (one row per order)
* loan-status report <- orders (start = order date, end = +90 days)
* transactions       <- lineitem
* fee rows           <- lineitem per order, fee type from the return flag

Every helper is a lazy DataFrame over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookshift.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def application_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan-application rows: one per order; applicant = the order's customer."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("loanid"),
        F.col("o_custkey").alias("applicationid"),
        F.concat(F.lit("c-"), F.col("o_custkey").cast("string")).alias("customerid"),
        F.date_add(F.lit("1960-01-01").cast("date"), F.col("c_nationkey")).alias("dob"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@mail.example")).alias("email"),
        F.concat(F.lit("c"), (F.col("o_custkey") + 1).cast("string"), F.lit("@mail.example"))
        .alias("jointapplicantemail"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("isjointapplication"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("issecuredrateloan"),
        F.col("o_orderpriority").alias("loanpurpose"))


APPLICATION_VIEW_SQL = """
SELECT o_orderkey AS loanid, o_custkey AS applicationid,
       'c-' || CAST(o_custkey AS VARCHAR) AS customerid,
       DATE '1960-01-01' + c_nationkey AS dob,
       'c' || CAST(o_custkey AS VARCHAR) || '@mail.example' AS email,
       'c' || CAST(o_custkey + 1 AS VARCHAR) || '@mail.example' AS jointapplicantemail,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS isjointapplication,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS issecuredrateloan,
       o_orderpriority AS loanpurpose
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def loan_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("loan_id"),
                    F.concat(F.lit("Lender\\"), F.col("o_orderstatus")).alias("loanstatus"),
                    F.col("o_orderdate").alias("startdate"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("enddate"))


LOAN_STATUS_SQL = """
SELECT o_orderkey AS loan_id, 'Lender\\' || o_orderstatus AS loanstatus,
       o_orderdate AS startdate, o_orderdate + INTERVAL 90 DAY AS enddate
FROM orders
"""


def lineitem_seq_cols() -> list[str]:
    """A total staged order for lineitem rows: (orderkey, linenumber) is not unique."""
    return ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def client_answers(spark, sf_dir):
    """Answers to "read client", one JSON body per customer."""
    key = F.col("c_custkey").cast("string")
    body = F.to_json(F.struct(F.concat(F.lit("key-c"), key).alias("encodedKey"), F.concat(F.lit("c"), key).alias("id")))
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), key).alias("request_id"),
                                                   F.lit(200).alias("status_code"), body.alias("body"))
