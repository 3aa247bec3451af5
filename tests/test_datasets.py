"""Inline fixtures for the dataset builders whose plan differs from the SQL shape."""

import json

from bookshift.plans import datasets, documents

WL = ("loanid bigint, applicationid string, customerid string, dob string, email string, "
      "jointapplicantemail string, isjointapplication int, issecuredrateloan int, loanpurpose string")


def _wl(spark, rows):
    return {"application_loans": spark.createDataFrame(rows, WL)}


def _row(loan, app, cust, dob="1980-01-01", email=None, joint_email=None, joint=0):
    return (loan, app, cust, dob, email or f"{cust}@x", joint_email, joint, 0, "car")


def test_applicants_by_role_matches_pairwise_definition(spark):
    rows = [
        _row(1, "A", "x-1"), _row(2, "A", "y-2", dob="1990-05-05"),       # joint application: two loans
        _row(3, "B", "z-3"),                                              # sole
        _row(4, "C", "w-4"), _row(5, "C", "w-4"), _row(6, "C", "v-6"),    # one customer on two loans
        _row(7, None, "n-7"),                                             # no application id
        _row(None, "C", "q-0"),                                           # no loan id
        _row(8, "D", "p-8"), _row(8, "D", "p-9"),                         # two applicants on one loan
    ]
    got = sorted(tuple(map(str, r)) for r in datasets.applicants_by_role(_wl(spark, rows)).collect())
    # Pairwise definition: every other loan of the same application, projected and de-duplicated.
    expected = set()
    for loan, app, cust, dob, *_ in rows:
        expected.add((cust, cust.replace("-", ""), dob, str(loan), "primary"))
        for loan2, app2, cust2, dob2, *_ in rows:
            if app is not None and app2 == app and loan is not None and loan2 is not None and loan2 != loan:
                expected.add((cust, cust2.replace("-", ""), dob2, str(loan), "secondary"))
    assert got == sorted(expected)


def test_joint_pairs_lookup_by_email(spark):
    rows = [
        _row(1, "A", "x-1", email="x@mail", joint_email="y@mail", joint=1),
        _row(2, "A", "y-2", email="y@mail", joint_email="x@mail", joint=1),
        _row(3, "B", "y-2", email="y@mail"),                          # same applicant again: no extra pair
        _row(4, "C", "X-1", email="x2@mail", joint_email="x@mail", joint=1),  # same id ignoring case
    ]
    got = sorted(tuple(r) for r in datasets.joint_applicant_pairs(_wl(spark, rows)["application_loans"])
                 .collect())
    assert got == [(1, "x-1", "y-2"), (2, "y-2", "x-1")]


def test_group_documents_payload(spark):
    fetched = spark.createDataFrame([(10, "key-b", "Secondary"), (10, "key-a", "primary"), (11, "key-c", "primary")],
                                    "loanid bigint, encodedKey string, application_role string")
    docs = documents.group_documents(fetched, order_by=["application_role", "encodedKey"])
    got = {r.id: json.loads(r.payload) for r in documents.group_payloads(docs).collect()}
    # "Secondary" sorts before "primary" (upper case first): staged order, not role order.
    assert got[10] == {"groupName": 10, "id": 10, "groupMembers": [
        {"clientKey": "key-b", "roles": [{"groupRoleNameKey": "role-key-secondary"}]},
        {"clientKey": "key-a", "roles": [{"groupRoleNameKey": "role-key-primary"}]}]}
    assert len(got[11]["groupMembers"]) == 1


def test_documents_hold_every_element_of_a_large_entity(spark):
    import datetime as dt
    ts = dt.datetime(2022, 12, 7)
    rows = [("7", ts, ts, ts, "Brokerage Fee", float(i)) for i in range(5000)] + \
           [("8", ts, ts, ts, "Transaction Fees", 1.0)]
    staged = spark.createDataFrame(rows, "loanid string, value_date timestamp_ntz, booking_date timestamp_ntz, "
                                         "first_repayment_date timestamp_ntz, fee_type string, amount double")
    got = {r.id: json.loads(r.payload)
           for r in documents.payloads(documents.disbursement_documents(staged, ["predefinedFeeKey", "amount"])).collect()}
    assert [f["amount"] for f in got["7"]["fees"]] == [float(i) for i in range(5000)] and len(got["8"]["fees"]) == 1

    fetched = spark.createDataFrame([(10, f"key-{i:05}", "primary") for i in range(3000)] + [(11, "key-x", "primary")],
                                    "loanid bigint, encodedKey string, application_role string")
    groups = {r.id: r for r in documents.group_payloads(documents.group_documents(fetched, order_by=["encodedKey"])).collect()}
    assert groups[10].n_members == 3000 and groups[11].n_members == 1
    members = json.loads(groups[10].payload)["groupMembers"]
    assert members[0]["clientKey"] == "key-00000" and members[-1]["roles"] == [{"groupRoleNameKey": "role-key-primary"}]
