import json

from bookshift.operators import requests as rq


def test_request_tables(spark):
    ids = spark.createDataFrame([(7,), (8,)], "id bigint")
    base = "https://api.test/api"
    delete = {r.request_id: r for r in rq.delete_requests(ids, "id", base, rq.LOANS_PATH).collect()}
    assert delete["7"].method == "DELETE" and delete["7"].url == base + "/loans/7" and delete["7"].body is None
    approve = rq.state_change_requests(ids, "id", rq.APPROVE_BODY, base).collect()[0]
    assert approve.url == base + "/loans/7:changeState" and json.loads(approve.body) == {"action": "APPROVE",
                                                                                       "notes": ""}
    undo = rq.state_change_requests(ids, "id", rq.UNDO_APPROVE_BODY, base).collect()[0]
    assert json.loads(undo.body)["action"] == "Undo_Approve"
    fetch = rq.fetch_requests(ids, "id", base, rq.CLIENTS_PATH, "FULL", 1000).collect()[0]
    assert fetch.method == "GET" and fetch.url == base + "/clients/7?detailsLevel=FULL&limit=1000"
    docs = spark.createDataFrame([("9", '{"id":"9","x":1}')], "id string, payload string")
    disb = rq.disburse_requests(docs, "id", "payload", base).collect()[0]
    assert disb.request_id == "9" and disb.url == base + "/loans/9/disbursement-transactions"
    create = rq.create_requests(spark.createDataFrame([(5, "{}")], "id int, payload string"), "id",
                                base_url=base, path=rq.GROUPS_PATH).collect()[0]
    assert (create.method, create.url, create.body) == ("POST", base + "/groups", "{}")


def test_response_summary_keeps_requests_without_answer(spark):
    reqs = spark.createDataFrame([("1", "GET", "u1", None), ("2", "GET", "u2", None)],
                                 "request_id string, method string, url string, body string")
    answers = spark.createDataFrame([("1", 200, '{"encodedKey":"k1"}')], "request_id string, status_code int, body string")
    got = {r.request_id: r for r in rq.response_summary(reqs, answers, "encodedKey string").collect()}
    assert (got["1"].status, got["1"].status_code, got["1"].encodedKey) == ("OK", 200, "k1")
    assert got["2"].status is None and got["2"].encodedKey is None


def test_split_responses_and_messages(spark):
    resp = spark.createDataFrame([("1", 204, None), ("2", 404, '{"errors":[1]}'), ("3", None, None)],
                                 "request_id string, status_code int, body string")
    ok, failed = rq.split_responses(resp)
    assert [r.request_id for r in ok.collect()] == ["1"]
    assert sorted((r.request_id, r.status) for r in failed.collect()) == [("2", "Not Found"), ("3", None)]
    msgs = {r.request_id: r.message for r in rq.outcome_messages(resp, "request_id", "Loan ").collect()}
    assert msgs == {"1": "Loan 1 is deleted", "2": "2Not Found", "3": "3"}
    approved = rq.outcome_messages(spark.createDataFrame([("4", 200)], "request_id string, status_code int"),
                                   "request_id", "", 200, " is approved").collect()[0]
    assert approved.message == "4 is approved"


def test_sink_order_is_global_across_partitions(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 500).select(((F.col("id") * 37) % 500).alias("k"))
    out = rq.sink_order(df, "k", num_partitions=4)
    parts = out.select("k", F.spark_partition_id().alias("p")).collect()
    by_part = {}
    for r in parts:
        by_part.setdefault(r.p, []).append(r.k)
    flat = [k for p in sorted(by_part) for k in by_part[p]]
    assert flat == sorted(flat) and len(by_part) > 1
