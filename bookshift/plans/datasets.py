"""Source datasets K5-K11 on the operational and application schemas.

Each builder takes ``t``, a mapping of table name -> DataFrame (see
``sources.tables.load_tables``, whose ``source`` mapping gives the tables' places
in the source systems), and returns a lazy DataFrame.  The SQL's joins, filters and
projections are written with the DataFrame API; Catalyst pushes the constant
filters into the scans and prunes columns.

Control tables (type masters, status master, title list) are small, but what a
plan estimates for them need not be.  Where they would meet a loan-sized table
by a handful of values they are broadcast by a hint: a shuffle by such a key
deals all rows to as many tasks as there are types.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookshift.functions.scalars import case_in_lists, iff, remove_text, strip_dashes, to_int
from bookshift.functions.temporal import add_months_keep_time, years_to_months
from bookshift.operators.joins import like_matches, spread
from bookshift.operators.product import beside
from bookshift.operators.rows import top_n_per_group
from bookshift.plans import specs

Tables = Mapping[str, DataFrame]


def _g(guids: Mapping[str, str] | None, name: str) -> str:
    return (guids or specs.DEFAULT_GUIDS)[name]


# -- K7 borrower details ------------------------------------------------------------

def client_details_operational(t: Tables, guids: Mapping[str, str] | None = None) -> DataFrame:
    km = t["io_keys_masterreference"].where(F.col("ymr_idlink_xfk") == _g(guids, "system_link"))
    pm = t["io_product_masterreference"]
    lm = t["io_link_masterreference"]
    cm = t["io_client_masterreference"]
    ct = t["io_client_typeindividual"]
    ca = t["io_client_addressdetail"]
    cc = t["io_client_contactdetail"]
    mobile = cc.where(F.col("ccd_idlink_xct") == _g(guids, "mobile_contact")).select(
        F.col("ccd_idlink_cmr").alias("m_cmr"), F.col("ccd_details").alias("mobile"))
    email = cc.where(F.col("ccd_idlink_xct") == _g(guids, "email_contact")).select(
        F.col("ccd_idlink_cmr").alias("e_cmr"), F.col("ccd_details").alias("email"))
    gender = t["io_control_clientgender"].select("xcgn_id")
    title = t["io_control_clienttitle"].select("xcti_id", "xcti_detail")
    j = (km.join(pm, pm.rmr_id == km.ymr_idlink_armnet)
         .join(lm, lm.lmr_idlink_code_id == km.ymr_idlink_armnet)
         .join(cm, cm.cmr_id == lm.lmr_idlink_cmr)
         .join(ct, ct.cti_idlink_cmr == cm.cmr_id)
         .join(ca, ca.cad_idlink_cmr == cm.cmr_id)
         .join(mobile, mobile.m_cmr == cm.cmr_id)
         .join(email, email.e_cmr == cm.cmr_id)
         # Left join whose columns are not read: it keeps its multiplicity.
         .join(gender, gender.xcgn_id == ct.cti_idlink_xcgn, "left")
         # The title is linked through the contact-type column, as in the source.
         .join(title, title.xcti_id == ct.cti_idlink_xct, "left"))
    return j.select(
        to_int("ymr_idlink_foreign").alias("loanid"),
        F.col("cti_firstname").alias("firstname"),
        F.col("cti_middlename").alias("middlename"),
        F.col("cti_surname").alias("surname"),
        F.col("cti_dob").cast("date").alias("birthdate"),
        F.col("mobile"), F.col("email"),
        F.col("cad_streetname").alias("line1"),
        F.col("cad_city").alias("city"),
        F.col("cad_state").alias("region"),
        F.lit(specs.CLIENT_COUNTRY).alias("country"),
        F.col("cad_postcode").alias("postcode"),
        F.col("rmr_vedascore").alias("veda_score"),
        F.col("xcti_detail").alias("title"))


# -- K8 applicants by role ----------------------------------------------------------

def applicants_by_role(t: Tables) -> DataFrame:
    """Primary applicant of each loan, plus every applicant of the other loans
    of the same application as ``secondary``; UNION (distinct).

    The secondary branch keeps the primary's customer id next to the
    secondary's entity id, as the source query does.

    Secondary rows are built without pairing loans with loans: the other
    loans' applicants are first reduced to distinct ``(application, id,
    birthdate)`` tuples with the number of loans carrying each tuple and
    the smallest such loan.  A loan then takes every tuple of its
    application except a tuple carried only by itself.  Each joined row is
    an output row, so the join is never larger than the result.
    """
    wl = t["application_loans"]
    pa = wl.select("customerid", "applicationid", F.col("dob").cast("date").alias("birthdate"), "loanid")
    primary = pa.select("customerid", strip_dashes("customerid").alias("id"), "birthdate", "loanid",
                        F.lit("primary").alias("application_role"))
    tuples = (wl.groupBy("applicationid", strip_dashes("customerid").alias("sec_id"),
                         F.col("dob").cast("date").alias("sec_birthdate"))
              .agg(F.count_distinct("loanid").alias("n_loans"), F.min("loanid").alias("only_loan")))
    # ``wl.loanid <> pa.loanid`` is never true for a null loan id.
    cond = (pa.applicationid == tuples.applicationid) & pa.loanid.isNotNull() & (
        (tuples.n_loans > 1) | (tuples.only_loan != pa.loanid))
    secondary = pa.join(tuples, cond).select(
        pa.customerid, F.col("sec_id").alias("id"), F.col("sec_birthdate").alias("birthdate"),
        pa.loanid, F.lit("secondary").alias("application_role"))
    return primary.union(secondary).distinct()


# -- K9 loan accounts -----------------------------------------------------------------

def loan_accounts_operational(t: Tables, guids: Mapping[str, str] | None = None,
                              status_prefix: str = specs.STATUS_PREFIX,
                              rate_prefix: str = specs.RATE_MASTER_PREFIX, block_rows: int | None = None) -> DataFrame:
    """Loan accounts with their dates and their recurring, scheduled and one-off
    tasks side by side.  With ``block_rows`` a loan's tasks are laid out in
    blocks of about that many rows (``product.beside``), for loans whose tasks
    no single row should hold."""
    km = t["io_keys_masterreference"].where(F.col("ymr_idlink_xfk") == _g(guids, "system_link"))
    pm = t["io_product_masterreference"]
    pcb = t["io_product_controlbalance"]
    cpb = F.broadcast(t["io_control_productbalance"].where(F.col("xrbl_id") == _g(guids, "loan_balance")))
    lm = t["io_link_masterreference"].where(F.col("lmr_idlink_association") == _g(guids, "funder_link"))
    cm = t["io_client_masterreference"]
    rate_master = t["io_control_productratemaster"]
    # Funder name LIKE pattern, tested once per distinct name; the links, as many
    # as loans, only meet the clients that passed, never the few names.
    funders = like_matches(rate_master.select("xrrm_detail"), "xrrm_detail",
                           cm.select(F.col("cmr_id").alias("f_cmr"), "cmr_name"), rate_prefix, "cmr_name")
    funder = (lm.join(funders, F.col("f_cmr") == lm.lmr_idlink_cmr)
              .join(pm.select(F.col("rmr_id").alias("f_rmr")), F.col("f_rmr") == lm.lmr_idlink_code_id)
              .select(F.col("lmr_idlink_code_id").alias("f_code"), F.col("cmr_name").alias("funder")))
    # The three dates of a loan in one pass; a kind of date a loan has several
    # times multiplies its rows, one it lacks drops them, as separate joins do.
    kinds = {specs.DATE_TYPE_DISBURSEMENT: "disb", specs.DATE_TYPE_APPROVED: "approved_date",
             specs.DATE_TYPE_MATURITY: "maturity_date"}
    dates = beside(t["io_product_controldate"].where(F.col("rcd_type").isin(list(kinds))), "rcd_idlink_rmr",
                          {name: (F.col("rcd_type") == kind, F.struct(F.col("rcd_currentstart").alias(name)))
                           for kind, name in kinds.items()}, outer=False, block_rows=block_rows)
    rate = t["io_product_controlrate"].where(F.col("rcr_type").isin(specs.RATE_TYPES_BORROWER)).select(
        F.col("rcr_idlink_rmr").alias("rate_rmr"), F.col("rcr_rate").alias("interest_rate"))
    mdt = t["io_product_loanmdt"].select(F.col("rlm_idlink_rmr").alias("mdt_rmr"),
                                         years_to_months("rlm_term_years").alias("loan_term"))
    status = F.broadcast(t["io_control_statusmaster"].select("xsu_id", remove_text("xsu_detail", status_prefix)
                                                             .alias("loan_status")))
    tp = t["io_task_pending"]
    tm = t["io_control_taskmaster"]
    plt = t["io_product_loantransfer"]
    cbd = t["io_client_bankdetail"].select("cbd_id", "cbd_accountname", "cbd_accountbsbno", "cbd_accountnumber")
    # A task stands once for each kind it is of, a scheduled or one-off task once
    # for each of its transfers; a loan's kinds then stand beside each other.
    user = F.col("xtkm_iduser")
    of_kind = {"regular": user.isin(specs.TASK_USERS_RECURRING), "scheduled": user.isin(specs.TASK_USERS_SCHEDULED),
               "one_off": user == specs.TASK_USER_ONE_OFF}
    wanted = sorted({*specs.TASK_USERS_RECURRING, *specs.TASK_USERS_SCHEDULED, specs.TASK_USER_ONE_OFF})
    tasks = (tp.join(F.broadcast(tm.where(user.isin(wanted))), F.col("xtkm_id") == F.col("kpd_idlink_xtkm"))
             .select(F.col("kpd_idlink_code").alias("code"), "kpd_id", "kpd_daystart", "kpd_datenext", "xtkm_iduser",
                     F.explode(F.array_compact(F.array(*[F.when(c, k) for k, c in of_kind.items()]))).alias("kind")))
    met = tasks.join(plt, (F.col("rdd_idlink_kpd") == F.col("kpd_id")) & (F.col("kind") != "regular"), "left")
    # rows without an account (every regular task) are spread by a second key
    apart = F.when(F.col("rdd_idlink_cbd").isNull(), F.xxhash64("kpd_id")).otherwise(F.lit(0).cast("long"))
    per_task = (met.withColumn("apart", apart).join(
        cbd.withColumn("no_account", F.lit(0).cast("long")),
        (F.col("cbd_id") == F.col("rdd_idlink_cbd")) & (F.col("apart") == F.col("no_account")), "left"))
    kind = F.col("kind")
    moved = F.col("rdd_idlink_kpd").isNotNull()
    loan_tasks = beside(per_task, "code", {
        "regular": (kind == "regular", F.struct(
            case_in_lists("xtkm_iduser", specs.TASK_USERS_FREQUENCY).alias("payment_frequency"),
            F.col("kpd_daystart").alias("recurring_repayment_day"))),
        "scheduled": ((kind == "scheduled") & moved, F.struct(
            F.col("kpd_datenext").alias("next_repayment_due_date"), F.col("rdd_processamount").alias("repayment_amount"),
            F.col("cbd_accountname").alias("account_name"), F.col("cbd_accountbsbno").alias("account_bsb"),
            F.col("cbd_accountnumber").alias("account_number"))),
        "one_off": ((kind == "one_off") & moved, F.struct(
            F.col("kpd_datenext").alias("adhoc_repayment_date"), F.col("rdd_processamount").alias("adhoc_repayment_amount"))),
    }, outer=True, block_rows=block_rows)
    armnet = F.col("ymr_idlink_armnet")
    j = (km.join(pm, pm.rmr_id == armnet)
         .join(pcb, pcb.rcb_idlink_rmr == armnet)
         .join(cpb, cpb.xrbl_id == pcb.rcb_idlink_xrbl)
         .join(funder, F.col("f_code") == armnet)
         .join(dates, F.col("rcd_idlink_rmr") == armnet)
         .join(rate, F.col("rate_rmr") == armnet)
         .join(mdt, F.col("mdt_rmr") == armnet)
         .join(status, status.xsu_id == pm.rmr_idlink_xsu)
         .join(loan_tasks, F.col("code") == armnet, "left"))
    return j.select(
        to_int("ymr_idlink_foreign").alias("loanid"), "funder", "approved_date", "interest_rate", "loan_term",
        F.col("rcb_currentvalue").alias("loan_amount"), "payment_frequency", "recurring_repayment_day",
        "loan_status", "next_repayment_due_date", "repayment_amount", "adhoc_repayment_date",
        "adhoc_repayment_amount", "account_name", "account_bsb", "account_number", "maturity_date")


# -- K10 loan attributes ---------------------------------------------------------------

def loan_attributes(t: Tables) -> DataFrame:
    wl = t["application_loans"]
    ls = t["application_security"].select(F.col("loanid").alias("ls_loanid"), "issecureloan")
    j = wl.join(ls, ls.ls_loanid == wl.loanid, "left")
    return j.select(wl.loanid,
                    iff(F.col("issecuredrateloan") == 1, "Secured", "Unsecured").alias("rate_type"),
                    F.col("loanpurpose").alias("loan_purpose"),
                    iff(F.coalesce(F.col("issecureloan"), F.lit(0)) == 1, "True", "False").alias("is_secure"))


# -- K11 disbursement fees ---------------------------------------------------------------

def disbursement_details(t: Tables, guids: Mapping[str, str] | None = None) -> DataFrame:
    km = t["io_keys_masterreference"].where(F.col("ymr_idlink_xfk") == _g(guids, "system_link"))
    pt = t["io_product_transaction"]
    ct = F.broadcast(t["io_control_transactionmaster"].where(F.col("xtrm_idtext").isin(specs.FEE_TYPES)))
    pcd = t["io_product_controldate"].where(F.col("rcd_type") == specs.DATE_TYPE_DISBURSEMENT)
    j = (km.join(pt, pt.rtm_idlink_rmr == km.ymr_idlink_armnet)
         .join(ct, ct.xtrm_id == pt.rtm_idlink_xtrm)
         .join(pcd, pcd.rcd_idlink_rmr == km.ymr_idlink_armnet))
    # The dates all follow from the start date: the rows are made distinct before they are derived.
    fees = j.select("ymr_idlink_foreign", "rcd_currentstart", "xtrm_idtext", "rtm_value").distinct()
    return fees.select(
        F.col("ymr_idlink_foreign").alias("loanid"),   # kept as text, as in the source
        F.col("rcd_currentstart").alias("value_date"),
        F.col("rcd_currentstart").alias("booking_date"),
        add_months_keep_time("rcd_currentstart", 1).alias("first_repayment_date"),
        F.col("xtrm_idtext").alias("fee_type"),
        F.col("rtm_value").alias("amount"))


# -- K6 loans with several pending one-off repayments -------------------------------------

def multi_adhoc(t: Tables, guids: Mapping[str, str] | None = None) -> DataFrame:
    km = t["io_keys_masterreference"].where(F.col("ymr_idlink_xfk") == _g(guids, "system_link"))
    tp = t["io_task_pending"]
    tm = F.broadcast(t["io_control_taskmaster"].where(F.col("xtkm_iduser") == specs.TASK_USER_ONE_OFF))
    # Tasks of other types go before the loans' tasks are gathered, and the join below drops their loans.
    tp = tp.join(tm, tm.xtkm_id == tp.kpd_idlink_xtkm, "left_semi")
    # The left join is made inner by the inner join on its columns; Catalyst plans it so.
    j = (km.join(tp, tp.kpd_idlink_code == km.ymr_idlink_armnet, "left")
         .join(tm, tm.xtkm_id == tp.kpd_idlink_xtkm))
    return (j.groupBy("ymr_idlink_foreign").agg(F.count_distinct("kpd_id").alias("count_of_pending"))
            .where(F.col("count_of_pending") > 1))


# -- K5 test cohort ----------------------------------------------------------------------------

def test_cohort(t: Tables, as_at: str = "2022-12-07", start_from: str = "2022-08-01", per_status: int = 5,
                guids: Mapping[str, str] | None = None, status_prefix: str = specs.STATUS_PREFIX) -> DataFrame:
    """Up to ``per_status`` sole and ``per_status`` joint loans per status,
    fewest transactions first, then latest start (nulls last / first
    written out, loan id as tie-break); tagged and united."""
    day = F.lit(as_at).cast("date")
    open_loans = t["loan_status_report"].where(day.between(F.col("startdate"), F.col("enddate"))
                                               & (F.col("startdate") >= F.lit(start_from).cast("date")))
    wl = t["application_loans"]
    kinds = (wl.where(F.col("isjointapplication") == 0).select("loanid", F.lit("sole").alias("application_type"))
             .unionByName(joint_applicant_pairs(wl).select("loanid", F.lit("joint").alias("application_type"))))
    base = open_loans.join(kinds, F.col("loanid") == F.col("loan_id"))
    # the few loans of the report pick the transactions that are counted
    km = (t["warehouse_keys_masterreference"].where(F.col("ymr_idlink_xfk") == _g(guids, "system_link"))
          .select(F.col("ymr_idlink_foreign").cast("bigint").alias("tran_loan"), "ymr_idlink_armnet"))
    known = km.join(open_loans.select("loan_id"), F.col("loan_id") == F.col("tran_loan"), "left_semi")
    pt = t["warehouse_product_transaction"].where(F.col("rtm_datee") < day)
    counted = (known.join(pt, F.col("rtm_idlink_rmr") == F.col("ymr_idlink_armnet"))
               .groupBy("tran_loan").agg(F.count_distinct("rtm_id").alias("count_of_tran")))
    shaped = base.join(counted, F.col("tran_loan") == F.col("loan_id")).select(
        "application_type", "loan_id",
        F.concat(F.lit("'"), F.col("loan_id").cast("string"), F.lit("'")).alias("loan_id_str"),
        "loanstatus", remove_text("loanstatus", status_prefix).alias("loan_status"), "startdate", "count_of_tran")
    return top_n_per_group(shaped, ["application_type", "loanstatus"],
                           [F.col("count_of_tran").asc_nulls_last(), F.col("startdate").desc_nulls_first(),
                            F.col("loan_id").asc()], per_status, "loan_seq")


def joint_applicant_pairs(wl: DataFrame, spread_hot: bool = False) -> DataFrame:
    """Distinct (loan, primary id, secondary id) of joint applications.

    The joint applicant is found by e-mail.  The looked-up side is first
    reduced to distinct (email, id): the output only reads those, so
    duplicates there would only multiply rows the DISTINCT removes.  With
    ``spread_hot`` an e-mail that a large share of the loans name is split over
    tasks (``joins.spread``).
    """
    sec = (wl.where((F.col("customerid") != "") & (F.col("customerid") != specs.ZERO_GUID))
           .select(F.col("email").alias("sec_email"), F.col("customerid").alias("sec_id")).distinct())
    pri = wl.where(F.col("isjointapplication") == 1).select(
        "loanid", F.col("customerid").alias("pri_id"), "jointapplicantemail")
    met = F.col("sec_email") == F.col("jointapplicantemail")
    if spread_hot:
        pri, sec, shares = spread(pri, sec, ["jointapplicantemail"], ["sec_email"])
        for a, b in shares:
            met = met & (F.col(a) == F.col(b))
    return (pri.join(sec, met)
            .where(F.lower("pri_id") != F.lower("sec_id"))
            .select("loanid", "pri_id", "sec_id").distinct())


# -- audit: applicants and borrowers matched on loan id and birth date only ----------------

def client_match_audit(applicants: DataFrame, details: DataFrame) -> DataFrame:
    """Keys ``(loanid, birthdate)`` where the applicant / borrower merge is not
    one-to-one.  Applicants (K8) and borrower details (K7) are matched on
    these two columns only, so two people with one birth date on one loan
    cross-match; ``staged_rows`` is the number of merged rows the key makes.
    Both sides are counted with partial aggregates before the (null-safe)
    join of the counts, so no key's rows are paired up.
    """
    from bookshift.operators.joins import merge_null_safe

    keys = ["loanid", "birthdate"]
    a = applicants.groupBy(*keys).agg(F.count(F.lit(1)).alias("applicant_rows"))
    b = details.groupBy(*keys).agg(F.count(F.lit(1)).alias("borrower_rows"))
    m = merge_null_safe(a, b, keys)
    return (m.where((F.col("applicant_rows") > 1) | (F.col("borrower_rows") > 1))
            .withColumn("staged_rows", F.col("applicant_rows") * F.col("borrower_rows")))
