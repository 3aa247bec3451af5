"""What the source datasets K5-K11 hold, stated over the driver tables.

DuckDB statements for the checks, written from the datasets' descriptions:
who borrows, what a loan looks like, which fees a disbursement has.  They know
nothing of the loan system's tables, so they check the stand-ins
(``loan_sources``) and the builders (``datasets``) together.
"""

from __future__ import annotations

#: loans that the loan system knows
_KNOWN = "o_orderpriority <> '4-NOT SPECIFIED'"
_BORN = "CAST(DATE '1960-01-01' + c_nationkey AS DATE)"

BORROWERS = f"""
SELECT CAST(o_orderkey AS INTEGER) AS loanid, 'Customer' AS firstname,
       CASE WHEN c_nationkey % 7 = 3 THEN NULL ELSE c_mktsegment END AS middlename, substr(c_name, 10) AS surname,
       {_BORN} AS birthdate, '04' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS mobile,
       'c' || CAST(c_custkey AS VARCHAR) || '@mail.example' AS email, c_name || ' Street' AS line1, n_name AS city,
       r_name AS region, 'Australia' AS country, lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS postcode,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS veda_score,
       CASE WHEN c_nationkey % 5 <> 4 THEN 'T' || CAST(n_regionkey AS VARCHAR) END AS title
FROM orders, customer, nation, region
WHERE c_custkey = o_custkey AND n_nationkey = c_nationkey AND r_regionkey = n_regionkey AND {_KNOWN}
"""

#: a loan is the secondary loan of each other loan of its customer
APPLICANTS = f"""
SELECT 'c-' || CAST(o_custkey AS VARCHAR) AS customerid, 'c' || CAST(o_custkey AS VARCHAR) AS id,
       {_BORN} AS birthdate, o_orderkey AS loanid, unnest(
           CASE WHEN count(*) OVER (PARTITION BY o_custkey) > 1 THEN ['primary', 'secondary'] ELSE ['primary'] END)
       AS application_role
FROM orders, customer WHERE c_custkey = o_custkey
"""

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Finalised' WHEN 'O' THEN 'Open' ELSE 'Pending' END"


def _transfers(line: int) -> str:
    """Due date, amount and account of the tasks of one line number; tasks and
    transfers of one key pair up."""
    key = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
    return (f"(SELECT l_orderkey, due, amount, l_suppkey FROM (SELECT {key}, l_shipdate AS due FROM lineitem) "
            f"JOIN (SELECT {key}, l_extendedprice AS amount FROM lineitem) USING ({key}) WHERE l_linenumber = {line})")


LOANS = f"""
SELECT CAST(o_orderkey AS INTEGER) AS loanid, n_name AS funder, o_orderdate - INTERVAL 7 DAY AS approved_date,
       price.l_tax AS interest_rate, 12 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS loan_term,
       o_totalprice AS loan_amount, CASE WHEN regular.l_orderkey IS NOT NULL THEN 'Monthly' END AS payment_frequency,
       regular.l_linenumber AS recurring_repayment_day, {_STATUS} AS loan_status,
       next.due AS next_repayment_due_date, next.amount AS repayment_amount, once.due AS adhoc_repayment_date,
       once.amount AS adhoc_repayment_amount, s_name AS account_name, lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS account_bsb,
       CAST(s_suppkey AS VARCHAR) AS account_number, o_orderdate + INTERVAL 5 YEAR AS maturity_date
FROM orders
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN lineitem price ON price.l_orderkey = o_orderkey AND price.l_linenumber IN (2, 3)
LEFT JOIN lineitem regular ON regular.l_orderkey = o_orderkey AND regular.l_linenumber IN (1, 3)
LEFT JOIN {_transfers(1)} next ON next.l_orderkey = o_orderkey
LEFT JOIN {_transfers(2)} once ON once.l_orderkey = o_orderkey
LEFT JOIN supplier ON s_suppkey = next.l_suppkey
WHERE {_KNOWN}
"""

ATTRIBUTES = """
SELECT o_orderkey AS loanid, CASE WHEN o_orderstatus = 'F' THEN 'Secured' ELSE 'Unsecured' END AS rate_type,
       o_orderpriority AS loan_purpose,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' THEN 'True' ELSE 'False' END AS is_secure
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)
"""

FEES = f"""
SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS loanid, o_orderdate AS value_date, o_orderdate AS booking_date,
       o_orderdate + INTERVAL 1 MONTH AS first_repayment_date,
       CASE l_returnflag WHEN 'A' THEN 'Establishment Fee' WHEN 'N' THEN 'Transaction Fees' ELSE 'Brokerage Fee' END
       AS fee_type, l_extendedprice AS amount
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE {_KNOWN}
"""

SEVERAL_ONE_OFF = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS ymr_idlink_foreign, n AS count_of_pending
FROM orders JOIN (SELECT l_orderkey, count(DISTINCT {{'p': l_partkey, 's': l_suppkey}}) AS n
                  FROM lineitem WHERE l_linenumber = 2 GROUP BY l_orderkey) ON l_orderkey = o_orderkey
WHERE n > 1 AND {_KNOWN}
"""


def cohort(as_at: str, start_from: str, per_status: int = 5) -> str:
    """Loans running at ``as_at``; joint ones (urgent or high) need a next
    customer who has a loan.  Fewest transactions first, then latest start."""
    joint = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
    return f"""
SELECT application_type, o_orderkey AS loan_id, '''' || CAST(o_orderkey AS VARCHAR) || '''' AS loan_id_str,
       'Lender' || chr(92) || loan_status AS loanstatus, loan_status, CAST(started AS VARCHAR) AS startdate,
       n AS count_of_tran, place AS loan_seq
FROM (SELECT *, row_number() OVER (PARTITION BY application_type, loan_status ORDER BY n, started DESC, o_orderkey) AS place
      FROM (SELECT *, CASE WHEN {joint} THEN 'joint' ELSE 'sole' END AS application_type, {_STATUS} AS loan_status,
                   CAST(o_orderdate AS DATE) AS started
            FROM orders SEMI JOIN customer ON c_custkey = o_custkey)
      JOIN (SELECT l_orderkey, count(DISTINCT {{'l': l_linenumber, 'p': l_partkey, 's': l_suppkey}}) AS n
            FROM lineitem WHERE CAST(l_shipdate AS DATE) < DATE '{as_at}' GROUP BY l_orderkey) ON l_orderkey = o_orderkey
      WHERE {_KNOWN} AND started BETWEEN DATE '{start_from}' AND DATE '{as_at}'
        AND CAST(o_orderdate + INTERVAL 90 DAY AS DATE) >= DATE '{as_at}'
        AND (application_type = 'sole' OR o_custkey + 1 IN (
             SELECT o_custkey FROM orders SEMI JOIN customer ON c_custkey = o_custkey)))
WHERE place <= {per_status}
"""
