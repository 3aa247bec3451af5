"""End-to-end documents from hand-written source rows (source-system schema).

Loans 1 and 2 are a joint application (Ann and Bob); loan 3 is a sole loan
with two one-off repayments and no scheduled task.  Expected documents are
written out from the rules, not produced by the code.
"""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from bookshift.plans import datasets, documents, specs

G = specs.DEFAULT_GUIDS
D = dt.datetime


def _t(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def tables(spark):
    t = {}
    t["io_keys_masterreference"] = _t(spark, [("1", "r1", G["system_link"]), ("2", "r2", G["system_link"]),
                                              ("3", "r3", G["system_link"]), ("9", "r9", "other-system")],
                                      "ymr_idlink_foreign string, ymr_idlink_armnet string, ymr_idlink_xfk string")
    t["io_product_masterreference"] = _t(spark, [("r1", 700, "s1"), ("r2", 650, "s1"), ("r3", 600, "s1")],
                                         "rmr_id string, rmr_vedascore int, rmr_idlink_xsu string")
    t["io_link_masterreference"] = _t(spark, [("r1", "cA", "applicant"), ("r2", "cB", "applicant"),
                                              ("r3", "cF", G["funder_link"])],
                                      "lmr_idlink_code_id string, lmr_idlink_cmr string, lmr_idlink_association string")
    t["io_client_masterreference"] = _t(spark, [("cA", "Ann Lee"), ("cB", "Bob Ray"), ("cF", "Acme Capital")],
                                        "cmr_id string, cmr_name string")
    t["io_client_typeindividual"] = _t(spark, [("cA", "Ann", "M", "Lee", D(1980, 1, 2), "g1", "t1"),
                                               ("cB", "Bob", "J", "Ray", D(1982, 3, 4), "g1", "t9")],
                                       "cti_idlink_cmr string, cti_firstname string, cti_middlename string, "
                                       "cti_surname string, cti_dob timestamp_ntz, cti_idlink_xcgn string, "
                                       "cti_idlink_xct string")
    t["io_client_addressdetail"] = _t(spark, [("cA", "1 Main St", "Sydney", "NSW", "2000"),
                                              ("cB", "2 High St", "Perth", "WA", "6000")],
                                      "cad_idlink_cmr string, cad_streetname string, cad_city string, "
                                      "cad_state string, cad_postcode string")
    t["io_client_contactdetail"] = _t(spark, [("cA", G["mobile_contact"], "0400"), ("cA", G["email_contact"], "ann@x"),
                                              ("cB", G["mobile_contact"], "0411"), ("cB", G["email_contact"], "bob@x")],
                                      "ccd_idlink_cmr string, ccd_idlink_xct string, ccd_details string")
    t["io_control_clientgender"] = _t(spark, [("g1",)], "xcgn_id string")
    t["io_control_clienttitle"] = _t(spark, [("t1", "Ms")], "xcti_id string, xcti_detail string")
    t["io_product_controlbalance"] = _t(spark, [("r3", G["loan_balance"], 5000.0), ("r3", "other", 1.0)],
                                        "rcb_idlink_rmr string, rcb_idlink_xrbl string, rcb_currentvalue double")
    t["io_control_productbalance"] = _t(spark, [(G["loan_balance"],), ("other",)], "xrbl_id string")
    t["io_control_productratemaster"] = _t(spark, [("Lender\\Provisional Rate\\Acme Capital",)],
                                           "xrrm_detail string")
    t["io_product_controldate"] = _t(spark, [("r3", 6, D(2023, 1, 31, 10)), ("r3", 2, D(2023, 1, 20, 9)),
                                             ("r3", 4, D(2028, 1, 31))],
                                     "rcd_idlink_rmr string, rcd_type int, rcd_currentstart timestamp_ntz")
    t["io_product_controlrate"] = _t(spark, [("r3", 2, 0.0899), ("r3", 7, 0.5)],
                                     "rcr_idlink_rmr string, rcr_type int, rcr_rate double")
    t["io_product_loanmdt"] = _t(spark, [("r3", 5)], "rlm_idlink_rmr string, rlm_term_years int")
    t["io_control_statusmaster"] = _t(spark, [("s1", "Lender\\Active")], "xsu_id string, xsu_detail string")
    t["io_task_pending"] = _t(spark, [("k1", "r3", "m111", 0, D(2023, 3, 1)), ("k2", "r3", "m111", 0, D(2023, 4, 1))],
                              "kpd_id string, kpd_idlink_code string, kpd_idlink_xtkm string, kpd_daystart int, "
                              "kpd_datenext timestamp_ntz")
    t["io_control_taskmaster"] = _t(spark, [("m111", 111), ("m107", 107)], "xtkm_id string, xtkm_iduser int")
    t["io_product_loantransfer"] = _t(spark, [("k1", "b1", 50.0), ("k2", "b1", 60.0)],
                                      "rdd_idlink_kpd string, rdd_idlink_cbd string, rdd_processamount double")
    t["io_client_bankdetail"] = _t(spark, [("b1", "J Smith", "062000", "12345678")],
                                   "cbd_id string, cbd_accountname string, cbd_accountbsbno string, "
                                   "cbd_accountnumber string")
    t["io_product_transaction"] = _t(spark, [("t1", "r3", "x1", 100.0, dt.date(2023, 1, 31)),
                                             ("t2", "r3", "x2", 25.5, dt.date(2023, 1, 31)),
                                             ("t3", "r3", "x9", 7.0, dt.date(2023, 1, 31))],
                                     "rtm_id string, rtm_idlink_rmr string, rtm_idlink_xtrm string, rtm_value double, "
                                     "rtm_datee date")
    t["io_control_transactionmaster"] = _t(spark, [("x1", "Establishment Fee"), ("x2", "Brokerage Fee"),
                                                   ("x9", "Interest")], "xtrm_id string, xtrm_idtext string")
    t["application_loans"] = _t(spark, [
        (1, "APP", "aa-11", "1980-01-02", "ann@x", "bob@x", 1, 0, "Car"),
        (2, "APP", "bb-22", "1982-03-04", "bob@x", "ann@x", 1, 0, "Car"),
        (3, "APP3", "cc-33", "1975-05-05", "cat@x", None, 0, 1, "Boat")],
        "loanid bigint, applicationid string, customerid string, dob string, email string, "
        "jointapplicantemail string, isjointapplication int, issecuredrateloan int, loanpurpose string")
    t["application_security"] = _t(spark, [(3, 1)], "loanid bigint, issecureloan int")
    return t


def _docs(df):
    return {r.id: (json.loads(r.payload), r.copies) for r in documents.payloads(df).collect()}


def test_client_documents(spark, tables):
    staged = documents.client_staged(datasets.applicants_by_role(tables),
                                     datasets.client_details_operational(tables))
    got = _docs(documents.client_documents(staged, ["loanid", "application_role"]))
    # Secondary rows carry the other applicant's birth date, which does not
    # match the loan's own borrower, so only the primaries merge.
    assert got == {
        "aa11": ({"_Additional_Client_Details": {"title": "Ms", "veda_score": 700, "wisrcustomerid": "aa-11"},
                  "addresses": [{"city": "Sydney", "country": "Australia", "line1": "1 Main St", "postcode": "2000",
                                 "region": "NSW"}],
                  "birthDate": "1980-01-02", "emailAddress": "ann@x", "firstName": "Ann", "id": "aa11",
                  "lastName": "Lee", "middleName": "M", "mobilePhone": "0400"}, 1),
        "bb22": ({"_Additional_Client_Details": {"veda_score": 650, "wisrcustomerid": "bb-22"},
                  "addresses": [{"city": "Perth", "country": "Australia", "line1": "2 High St", "postcode": "6000",
                                 "region": "WA"}],
                  "birthDate": "1982-03-04", "emailAddress": "bob@x", "firstName": "Bob", "id": "bb22",
                  "lastName": "Ray", "middleName": "J", "mobilePhone": "0411"}, 1),
    }


def test_group_documents(spark, tables):
    staged = documents.client_staged(datasets.applicants_by_role(tables),
                                     datasets.client_details_operational(tables))
    fetched = staged.select("loanid", "application_role", F.concat(F.lit("key-"), "id").alias("encodedKey"))
    groups = documents.group_documents(fetched, order_by=["application_role", "encodedKey"])
    got = {r.id: json.loads(r.payload) for r in documents.group_payloads(groups).collect()}
    assert got == {
        1: {"groupName": 1, "id": 1, "groupMembers": [
            {"clientKey": "key-aa11", "roles": [{"groupRoleNameKey": "role-key-primary"}]}]},
        2: {"groupName": 2, "id": 2, "groupMembers": [
            {"clientKey": "key-bb22", "roles": [{"groupRoleNameKey": "role-key-primary"}]}]},
    }


def test_loan_document_with_two_one_off_repayments(spark, tables):
    funders = spark.createDataFrame([("branch-1", "Acme Capital")], "encodedKey string, funder string")
    group_keys = spark.createDataFrame([("grp-3", 3)], "accountHolderKey string, loanid bigint")
    staged = documents.loan_staged(datasets.loan_accounts_operational(tables), datasets.loan_attributes(tables),
                                   funders, group_keys, "trial-1")
    got = _docs(documents.loan_documents(staged, order_by=["adhoc_repayment_date", "adhoc_repayment_amount"]))
    assert got == {3: ({
        "id": 3, "accountHolderKey": "grp-3", "assignedBranchKey": "branch-1", "accountHolderType": "Group",
        "productTypeKey": "product-key-placeholder", "loanAmount": 5000.0,
        "interestSettings": {"accrueInterestAfterMaturity": False, "interestApplicationMethod": "REPAYMENT_DUE_DATE",
                             "interestBalanceCalculationMethod": "PRINCIPAL_AND_INTEREST",
                             "interestCalculationMethod": "DECLINING_BALANCE_DISCOUNTED",
                             "interestChargeFrequency": "ANNUALIZED", "interestRate": 0.0899,
                             "interestRateSource": "FIXED_INTEREST_RATE", "interestType": "SIMPLE_INTEREST"},
        "scheduleSettings": {"gracePeriod": 0, "gracePeriodType": "NONE", "periodicPayment": 0,
                             "principalRepaymentInterval": 1, "repaymentInstallments": 60,
                             "repaymentPeriodCount": 1, "repaymentPeriodUnit": "MONTHS",
                             "repaymentScheduleMethod": "DYNAMIC", "scheduleDueDatesMethod": "INTERVAL"},
        "redrawSettings": {"restrictNextDueWithdrawal": False},
        "_additional_loan_details": {"approved_date": "2023-01-20T09:00:00+11:00", "is_secure": "True",
                                     "loan_purpose": "Boat", "loan_status": "Active",
                                     "maturity_date": "2028-01-31T00:00:00+11:00", "rate_type": "Secured",
                                     "test_group": "trial-1"},
        # two staged rows without a scheduled task: [null, null] survives
        "_repayment_details": [None, None],
        "_adhoc_repayment_details": [
            {"adhoc_repayment_amount": 50.0, "adhoc_repayment_date": "2023-03-01T00:00:00+11:00"},
            {"adhoc_repayment_amount": 60.0, "adhoc_repayment_date": "2023-04-01T00:00:00+11:00"}],
    }, 2)}
    # no bank account (all fields null) -> attribute absent (P5)


def test_disbursement_document(spark, tables):
    k11 = datasets.disbursement_details(tables)
    assert k11.count() == 2  # the 'Interest' transaction is not a fee
    got = _docs(documents.disbursement_documents(k11, ["predefinedFeeKey", "amount"]))
    assert got == {"3": ({
        "id": "3", "bookingDate": "2023-01-31T10:00:00+11:00", "valueDate": "2023-01-31T10:00:00+11:00",
        "firstRepaymentDate": "2023-02-28T10:00:00+11:00",
        "fees": [{"amount": 25.5, "predefinedFeeKey": "fee-key-brokerage"},
                 {"amount": 100.0, "predefinedFeeKey": "fee-key-establishment"}],
        "transactionDetails": {"transactionChannelId": "settlement"}}, 1)}


def test_cohort_and_audit(spark, tables):
    assert datasets.multi_adhoc(tables).collect()[0].asDict() == {"ymr_idlink_foreign": "3", "count_of_pending": 2}
    pairs = sorted(tuple(r) for r in datasets.joint_applicant_pairs(tables["application_loans"]).collect())
    assert pairs == [(1, "aa-11", "bb-22"), (2, "bb-22", "aa-11")]


def test_client_quarantine_lists_rows_lost_to_null_keys(spark):
    staged = spark.createDataFrame(
        [(1, "2000-01-01", "aa", "Ann", None, "Lee", "0400", "a@x", "primary"),
         (2, "2000-01-02", "bb", "Bob", "J", "Ray", "0411", "b@x", "primary")],
        "loanid int, birthdate string, id string, firstname string, middlename string, surname string, "
        "mobile string, email string, application_role string").withColumn("birthdate", F.col("birthdate").cast("date"))
    q = documents.client_quarantine(staged).collect()
    assert [(r.id, r.null_keys) for r in q] == [("aa", "middleName")]
