"""Request and response tables for the target API.

The original sent one HTTP call per document from the driver.  Here the
calls become a *request table* ``(request_id, method, url, body)`` that any
sender (a partitioned job, a message queue, a bulk loader) can work through
in parallel, and the answers come back as a *response table*
``(request_id, status_code, body)``.  Joining the two on ``request_id``
replaces the original's attach-by-position.
"""

from __future__ import annotations

from http import HTTPStatus

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookshift.functions.jsonio import answer_columns, flatten_undeclared

# Placeholder API address and paths of the target system.
DEFAULT_BASE_URL = "https://banking-api.example/api"
CLIENTS_PATH = "/clients/"
LOANS_PATH = "/loans/"
GROUPS_PATH = "/groups"
GROUP_PATH = "/groups/"
DISBURSE_SUFFIX = "/disbursement-transactions"
CHANGE_STATE_SUFFIX = ":changeState"

# State-change bodies.
APPROVE_BODY = '{"action":"APPROVE","notes":""}'
UNDO_APPROVE_BODY = '{"action":"Undo_Approve","notes":""}'

REQUEST_COLS = ["request_id", "method", "url", "body"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def create_requests(payloads: DataFrame, id_col: str, body_col: str = "payload",
                    base_url: str = DEFAULT_BASE_URL, path: str = CLIENTS_PATH) -> DataFrame:
    """One POST per document (A9): clients, loans (``/loans/``) or groups (``/groups``)."""
    return payloads.select(_c(id_col).cast("string").alias("request_id"), F.lit("POST").alias("method"),
                           F.lit(base_url + path).alias("url"), _c(body_col).alias("body"))


def delete_requests(ids: DataFrame, id_col: str, base_url: str = DEFAULT_BASE_URL,
                    path: str = CLIENTS_PATH) -> DataFrame:
    """One DELETE per id, no body (A10)."""
    return ids.select(_c(id_col).cast("string").alias("request_id"), F.lit("DELETE").alias("method"),
                      F.concat(F.lit(base_url + path), _c(id_col).cast("string")).alias("url"),
                      F.lit(None).cast("string").alias("body"))


def state_change_requests(ids: DataFrame, id_col: str, body: str = APPROVE_BODY,
                          base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """Approve / undo approval of loans."""
    return ids.select(_c(id_col).cast("string").alias("request_id"), F.lit("POST").alias("method"),
                      F.concat(F.lit(base_url + LOANS_PATH), _c(id_col).cast("string"),
                               F.lit(CHANGE_STATE_SUFFIX)).alias("url"),
                      F.lit(body).alias("body"))


def disburse_requests(payloads: DataFrame, id_col: str = "id", body_col: str = "payload",
                      base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """Disburse each loan; ``id_col`` is the document's loan id."""
    loan_id = _c(id_col).cast("string")
    return payloads.select(loan_id.alias("request_id"), F.lit("POST").alias("method"),
                           F.concat(F.lit(base_url + LOANS_PATH), loan_id, F.lit(DISBURSE_SUFFIX)).alias("url"),
                           _c(body_col).alias("body"))


def fetch_requests(ids: DataFrame, id_col: str, base_url: str = DEFAULT_BASE_URL, path: str = CLIENTS_PATH,
                   details_level: str = "Full", limit: int = 1000) -> DataFrame:
    """One GET per id with details level and page limit as query string (A5, O3)."""
    return ids.select(_c(id_col).cast("string").alias("request_id"), F.lit("GET").alias("method"),
                      F.concat(F.lit(base_url + path), _c(id_col).cast("string"),
                               F.lit(f"?detailsLevel={details_level}&limit={limit}")).alias("url"),
                      F.lit(None).cast("string").alias("body"))


def http_reason(code: str | Column) -> Column:
    """Status code -> reason phrase (``200`` -> ``OK``), from the standard list."""
    m = F.create_map(*[x for s in HTTPStatus for x in (F.lit(int(s.value)), F.lit(s.phrase))])
    return F.try_element_at(m, _c(code).cast("int"))


def response_summary(requests: DataFrame, responses: DataFrame, body_schema: str | None = None,
                     key: str = "request_id", flatten: bool = False, columns: dict[str, str] | None = None,
                     prefix: str = "") -> DataFrame:
    """Requests joined to their responses: status text, status code, body.

    With ``body_schema`` the body is parsed and its fields become columns.
    With ``flatten`` bodies of undeclared and differing shapes become a column
    for every path met in any answer (``errors_0_errorCode``): the schema of
    all answers is found by one aggregate, or given as ``columns`` (see
    ``answer_columns``).  A request with no response keeps a null status (left
    join).
    """
    joined = requests.join(responses.withColumnRenamed("body", "response_body"), key, "left")
    out = joined.select(key, http_reason("status_code").alias("status"), F.col("status_code"),
                        F.col("response_body"))
    if body_schema:
        parsed = F.from_json(F.col("response_body"), body_schema)
        out = out.select("*", parsed.alias("__b")).select(key, "status", "status_code", "__b.*")
    elif flatten:
        columns = answer_columns(responses, "body") if columns is None else columns
        out = flatten_undeclared(out, "response_body", [key, "status", "status_code"], columns=columns, prefix=prefix)
    return out


def split_responses(responses: DataFrame, ok_codes: tuple[int, ...] = (200, 201, 204)
                    ) -> tuple[DataFrame, DataFrame]:
    """(answered, failed): failed reads go to their own output with the
    reason phrase instead of being flattened into the entity data (A5)."""
    ok = F.col("status_code").isin(list(ok_codes))
    failed = responses.where(~ok | F.col("status_code").isNull()).withColumn(
        "status", http_reason("status_code"))
    return responses.where(ok), failed


def fetch_result(asked: DataFrame, responses: DataFrame, body_schema: str, key: str = "request_id",
                 ok_codes: tuple[int, ...] = (200, 201, 204)) -> DataFrame:
    """One row per requested id, with the columns of ``asked`` (its order
    column among them), the status code and the body's fields (A5).  A read
    that failed or was never answered keeps its row with null fields;
    ``split_responses`` gives the failed answers themselves."""
    body = F.when(F.col("status_code").isin(list(ok_codes)), F.from_json("body", body_schema))
    answers = responses.select(key, "status_code", body.alias("__b"))
    return asked.join(answers, key, "left").select(*asked.columns, "status_code", "__b.*")


def union_flattened(*frames: DataFrame) -> DataFrame:
    """Row-concatenate flattened answers whose columns differ (U3); missing
    columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def outcome_messages(responses: DataFrame, id_col: str, entity: str, success_code: int = 204,
                     success_text: str = " is deleted") -> DataFrame:
    """One message per response (A14): ``'Client 7 is deleted'`` on success,
    else the id followed by the reason phrase.  Delete succeeds with 204,
    state change with 200 (``success_text=' is approved'``)."""
    ok = F.col("status_code") == F.lit(success_code)
    msg = F.when(ok, F.concat(F.lit(entity), _c(id_col).cast("string"), F.lit(success_text))) \
        .otherwise(F.concat(_c(id_col).cast("string"), F.coalesce(http_reason("status_code"), F.lit(""))))
    return responses.select(_c(id_col).alias(id_col) if isinstance(id_col, str) else _c(id_col),
                            F.col("status_code"), msg.alias("message"))


def sink_order(df: DataFrame, *keys: str, num_partitions: int | None = None) -> DataFrame:
    """Order rows by key for a sink (O1: documents in key order).

    Range partitioning (bounds from a sample) plus a sort inside each
    partition: the part files, read in name order, are globally sorted, and
    no task sorts more than its own range.  Keys should be close to unique;
    a key holding many rows stays in one range.
    """
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def entity_ids(df: DataFrame, id_col: str, distinct: bool = False) -> DataFrame:
    """The id column of a master frame as a DataFrame (A15); distinct for groups."""
    out = df.select(_c(id_col).alias("id"))
    return out.distinct() if distinct else out
