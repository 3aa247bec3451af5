"""bookshift: loan-book migration pipelines on Spark.

Reads source tables as DataFrames, reconciles borrowers, loans, repayments and
disbursements, stamps dates with a time zone, nests rows into one JSON document
per entity and turns the documents into request tables for a target banking
API.  Everything is native DataFrame / Spark SQL expressions; no Python UDFs.

Sub-packages (``llm``, when installed, adds training-data operators):

* ``sources``    table loading, cohort filters, API response tables
* ``functions``  column functions (casts, strings, dates, time-zone stamp, JSON)
* ``operators``  DataFrame -> DataFrame building blocks (joins, nesting, dedup,
                 top-N, request tables)
* ``plans``      named datasets (client / group / loan / disbursement documents,
                 source queries) and the query catalog used by the checks
"""

from bookshift.session import get_session

__all__ = ["get_session"]
