"""Loan-system source tables derived from the driver tables.

The operational system (``io_*`` tables) and the application warehouse
views are written as one SQL text per table over the driver tables (orders =
loans, customer = clients, nation = funders, lineitem = tasks, transfers and
transactions, supplier = bank accounts), run with ``spark.sql(text, orders=df,
...)``.  The dataset builders in ``datasets`` run unchanged on these tables;
the checks (``expected``) state the results over the driver tables directly.

Every table is a projection, union or DISTINCT over whole driver tables, so
its size grows with them; rows that must find no partner carry a key that the
other table lacks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bookshift.plans import specs
from bookshift.sources.tables import read_table

G = specs.DEFAULT_GUIDS
DRIVER_TABLES = ["orders", "customer", "nation", "region", "supplier", "lineitem"]

# Task type per line number: 1 scheduled monthly, 2 one-off, 3 recurring
# (recovery) monthly, anything else a type the queries ignore.
_TASK_USER = "CASE l_linenumber WHEN 1 THEN 107 WHEN 2 THEN 111 WHEN 3 THEN 115 ELSE 199 END"
_TASK_ID = ("'kpd-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
            "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)")

SOURCES: dict[str, str] = {
    "io_keys_masterreference": f"""
SELECT CAST(o_orderkey AS STRING) AS ymr_idlink_foreign,
       'rmr-' || CAST(o_orderkey AS STRING) AS ymr_idlink_armnet,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'guid-other-system'
            ELSE '{G["system_link"]}' END AS ymr_idlink_xfk
FROM {{orders}}""",
    "io_product_masterreference": """
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS rmr_id,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS rmr_vedascore,
       'xsu-' || o_orderstatus AS rmr_idlink_xsu
FROM {orders}""",
    "io_link_masterreference": f"""
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS lmr_idlink_code_id,
       'cmr-' || CAST(o_custkey AS STRING) AS lmr_idlink_cmr,
       'guid-applicant-link' AS lmr_idlink_association
FROM {{orders}}
UNION ALL
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS lmr_idlink_code_id,
       'cmr-n' || CAST(c_nationkey AS STRING) AS lmr_idlink_cmr,
       '{G["funder_link"]}' AS lmr_idlink_association
FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey""",
    "io_client_masterreference": """
SELECT 'cmr-' || CAST(c_custkey AS STRING) AS cmr_id, c_name AS cmr_name FROM {customer}
UNION ALL
SELECT 'cmr-n' || CAST(n_nationkey AS STRING) AS cmr_id, n_name AS cmr_name FROM {nation}""",
    "io_client_typeindividual": """
SELECT 'cmr-' || CAST(c_custkey AS STRING) AS cti_idlink_cmr,
       'Customer' AS cti_firstname, CASE WHEN c_nationkey % 7 = 3 THEN NULL ELSE c_mktsegment END AS cti_middlename,
       substr(c_name, 10) AS cti_surname,
       CAST(DATE '1960-01-01' + c_nationkey AS TIMESTAMP) AS cti_dob,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'xcgn-unknown' ELSE 'xcgn-' || substr(c_mktsegment, 1, 1) END
       AS cti_idlink_xcgn,
       CASE WHEN c_nationkey % 5 = 4 THEN 'xct-unknown' ELSE 'xct-' || CAST(c_nationkey AS STRING) END AS cti_idlink_xct
FROM {customer}""",
    "io_client_addressdetail": """
SELECT 'cmr-' || CAST(c_custkey AS STRING) AS cad_idlink_cmr, c_name || ' Street' AS cad_streetname,
       n_name AS cad_city, r_name AS cad_state, lpad(CAST(c_nationkey AS STRING), 4, '0') AS cad_postcode
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey JOIN {region} ON r_regionkey = n_regionkey""",
    "io_client_contactdetail": f"""
SELECT 'cmr-' || CAST(c_custkey AS STRING) AS ccd_idlink_cmr, '{G["mobile_contact"]}' AS ccd_idlink_xct,
       '04' || lpad(CAST(c_custkey AS STRING), 8, '0') AS ccd_details
FROM {{customer}}
UNION ALL
SELECT 'cmr-' || CAST(c_custkey AS STRING) AS ccd_idlink_cmr, '{G["email_contact"]}' AS ccd_idlink_xct,
       'c' || CAST(c_custkey AS STRING) || '@mail.example' AS ccd_details
FROM {{customer}}""",
    "io_control_clientgender": """
SELECT DISTINCT 'xcgn-' || substr(c_mktsegment, 1, 1) AS xcgn_id FROM {customer}""",
    "io_control_clienttitle": """
SELECT 'xct-' || CAST(n_nationkey AS STRING) AS xcti_id, 'T' || CAST(n_regionkey AS STRING) AS xcti_detail
FROM {nation}""",
    "io_product_controlbalance": f"""
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS rcb_idlink_rmr, '{G["loan_balance"]}' AS rcb_idlink_xrbl,
       o_totalprice AS rcb_currentvalue
FROM {{orders}}
UNION ALL
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS rcb_idlink_rmr, 'guid-other-balance' AS rcb_idlink_xrbl,
       0.0 AS rcb_currentvalue
FROM {{orders}}""",
    "io_control_productbalance": f"""
SELECT DISTINCT CASE WHEN o_orderstatus = 'F' THEN '{G["loan_balance"]}' ELSE 'guid-other-balance' END
       AS xrbl_id
FROM {{orders}}""",
    "io_control_productratemaster": """
SELECT 'Lender' || chr(92) || 'Provisional Rate' || chr(92) || n_name AS xrrm_detail FROM {nation}""",
    "io_product_controldate": """
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS rcd_idlink_rmr, 6 AS rcd_type, o_orderdate AS rcd_currentstart
FROM {orders}
UNION ALL
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS rcd_idlink_rmr, 2 AS rcd_type,
       o_orderdate - INTERVAL '7' DAY AS rcd_currentstart
FROM {orders}
UNION ALL
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS rcd_idlink_rmr, 4 AS rcd_type,
       o_orderdate + INTERVAL '5' YEAR AS rcd_currentstart
FROM {orders}""",
    "io_product_controlrate": """
SELECT 'rmr-' || CAST(l_orderkey AS STRING) AS rcr_idlink_rmr, l_linenumber AS rcr_type, l_tax AS rcr_rate
FROM {lineitem}""",
    "io_product_loanmdt": """
SELECT 'rmr-' || CAST(o_orderkey AS STRING) AS rlm_idlink_rmr,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS rlm_term_years
FROM {orders}""",
    "io_control_statusmaster": """
SELECT DISTINCT 'xsu-' || o_orderstatus AS xsu_id,
       'Lender' || chr(92) || CASE o_orderstatus WHEN 'F' THEN 'Finalised' WHEN 'O' THEN 'Open'
                                ELSE 'Pending' END AS xsu_detail
FROM {orders}""",
    "io_task_pending": f"""
SELECT {_TASK_ID} AS kpd_id, 'rmr-' || CAST(l_orderkey AS STRING) AS kpd_idlink_code,
       'xtkm-' || CAST({_TASK_USER} AS STRING) AS kpd_idlink_xtkm,
       l_linenumber AS kpd_daystart, l_shipdate AS kpd_datenext
FROM {{lineitem}}""",
    "io_control_taskmaster": f"""
SELECT DISTINCT 'xtkm-' || CAST({_TASK_USER} AS STRING) AS xtkm_id, {_TASK_USER} AS xtkm_iduser
FROM {{lineitem}}""",
    "io_product_loantransfer": f"""
SELECT {_TASK_ID} AS rdd_idlink_kpd, 'cbd-' || CAST(l_suppkey AS STRING) AS rdd_idlink_cbd,
       l_extendedprice AS rdd_processamount
FROM {{lineitem}}""",
    "io_client_bankdetail": """
SELECT 'cbd-' || CAST(s_suppkey AS STRING) AS cbd_id, s_name AS cbd_accountname,
       lpad(CAST(s_nationkey AS STRING), 6, '0') AS cbd_accountbsbno,
       CAST(s_suppkey AS STRING) AS cbd_accountnumber
FROM {supplier}""",
    "io_product_transaction": f"""
SELECT {_TASK_ID} AS rtm_id, 'rmr-' || CAST(l_orderkey AS STRING) AS rtm_idlink_rmr,
       'xtrm-' || l_returnflag AS rtm_idlink_xtrm, l_extendedprice AS rtm_value,
       CAST(l_shipdate AS DATE) AS rtm_datee
FROM {{lineitem}}""",
    "io_control_transactionmaster": """
SELECT DISTINCT 'xtrm-' || l_returnflag AS xtrm_id,
       CASE l_returnflag WHEN 'A' THEN 'Establishment Fee' WHEN 'N' THEN 'Transaction Fees'
                         ELSE 'Brokerage Fee' END AS xtrm_idtext
FROM {lineitem}""",
    # -- application warehouse -------------------------------------------------
    "application_loans": """
SELECT o_orderkey AS loanid, 'app-' || CAST(o_custkey AS STRING) AS applicationid,
       'c-' || CAST(o_custkey AS STRING) AS customerid,
       CAST(DATE '1960-01-01' + c_nationkey AS STRING) AS dob,
       'c' || CAST(o_custkey AS STRING) || '@mail.example' AS email,
       'c' || CAST(o_custkey + 1 AS STRING) || '@mail.example' AS jointapplicantemail,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS isjointapplication,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS issecuredrateloan,
       o_orderpriority AS loanpurpose
FROM {orders} JOIN {customer} ON c_custkey = o_custkey""",
    "application_security": """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN -o_orderkey ELSE o_orderkey END AS loanid,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE NULL END AS issecureloan
FROM {orders}""",
    "loan_status_report": """
SELECT o_orderkey AS loan_id,
       'Lender' || chr(92) || CASE o_orderstatus WHEN 'F' THEN 'Finalised' WHEN 'O' THEN 'Open'
                                ELSE 'Pending' END AS loanstatus,
       CAST(o_orderdate AS DATE) AS startdate,
       CAST(o_orderdate + INTERVAL '90' DAY AS DATE) AS enddate
FROM {orders}""",
}
# The warehouse's copies of the operational tables.
SOURCES["warehouse_keys_masterreference"] = SOURCES["io_keys_masterreference"]
SOURCES["warehouse_product_transaction"] = SOURCES["io_product_transaction"]


def source_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Stand-in source tables as lazy Spark DataFrames."""
    base = {t: read_table(spark, sf_dir, t) for t in DRIVER_TABLES}
    out = {}
    for name in names or list(SOURCES):
        text = SOURCES[name]
        used = {t: df for t, df in base.items() if "{" + t + "}" in text}
        out[name] = spark.sql(text, **used)
    return out
