"""Document shapes as data: field sets, group keys, renames, defaults, code maps.

Field names and the product defaults are fixed by the target API's document
format.  Organisation-specific keys (product, role and fee keys, link-type
GUIDs) are parameters; the defaults here are neutral placeholders.
"""

from __future__ import annotations

from bookshift.operators.nest import FieldSet

# ---------------------------------------------------------------------------
# Client documents.
# ---------------------------------------------------------------------------
CLIENT_RENAMES = {
    "firstname": "firstName",
    "middlename": "middleName",
    "surname": "lastName",
    "mobile": "mobilePhone",
    "email": "emailAddress",
    "birthdate": "birthDate",
    "customerid": "wisrcustomerid",
}
CLIENT_KEYS = ["id", "firstName", "middleName", "lastName", "birthDate", "mobilePhone", "emailAddress"]
CLIENT_FIELD_SETS = [
    FieldSet("addresses", ["line1", "city", "region", "postcode", "country"], array=True),
    FieldSet("_Additional_Client_Details", ["veda_score", "title", "wisrcustomerid"], array=False),
]
CLIENT_COUNTRY = "Australia"

# ---------------------------------------------------------------------------
# Loan documents.
# ---------------------------------------------------------------------------
LOAN_DEFAULTS = {
    "accountHolderType": "Group",
    "productTypeKey": "product-key-placeholder",
    "interestRateSource": "FIXED_INTEREST_RATE",
    "accrueInterestAfterMaturity": False,
    "interestApplicationMethod": "REPAYMENT_DUE_DATE",
    "interestBalanceCalculationMethod": "PRINCIPAL_AND_INTEREST",
    "interestCalculationMethod": "DECLINING_BALANCE_DISCOUNTED",
    "interestChargeFrequency": "ANNUALIZED",
    "interestType": "SIMPLE_INTEREST",
    "principalRepaymentInterval": 1,
    "gracePeriod": 0,
    "gracePeriodType": "NONE",
    "repaymentPeriodCount": 1,
    "scheduleDueDatesMethod": "INTERVAL",
    "periodicPayment": 0,
    "repaymentPeriodUnit": "MONTHS",
    "repaymentScheduleMethod": "DYNAMIC",
    "paymentPlan": None,
    "restrictNextDueWithdrawal": False,
}
# Date-time columns stamped with the zone offset.  The ad-hoc repayment date
# is stamped too: left raw it would reach the JSON encoder as a timestamp.
LOAN_DATETIME_COLS = ["approved_date", "next_repayment_due_date", "maturity_date", "adhoc_repayment_date"]
LOAN_RENAMES = {
    "loanid": "id",
    "interest_rate": "interestRate",
    "loan_term": "repaymentInstallments",
    "encodedKey": "assignedBranchKey",
    "loan_amount": "loanAmount",
}
LOAN_KEYS = ["id", "accountHolderKey", "assignedBranchKey", "accountHolderType", "productTypeKey", "loanAmount"]
LOAN_FIELD_SETS = [
    FieldSet("interestSettings", [
        "interestRateSource", "accrueInterestAfterMaturity", "interestApplicationMethod",
        "interestBalanceCalculationMethod", "interestCalculationMethod", "interestChargeFrequency",
        "interestRate", "interestType"]),
    FieldSet("scheduleSettings", [
        "principalRepaymentInterval", "gracePeriod", "gracePeriodType", "repaymentInstallments",
        "repaymentPeriodCount", "scheduleDueDatesMethod", "periodicPayment", "repaymentPeriodUnit",
        "repaymentScheduleMethod", "paymentPlan"]),
    FieldSet("redrawSettings", ["restrictNextDueWithdrawal"]),
    FieldSet("_additional_loan_details", [
        "approved_date", "is_secure", "loan_purpose", "rate_type", "test_group", "loan_status",
        "maturity_date"]),
    FieldSet("_customer_bank_account_details", ["account_name", "account_number", "account_bsb"]),
    FieldSet("_repayment_details", [
        "next_repayment_due_date", "payment_frequency", "repayment_amount", "recurring_repayment_day"],
        array=True),
    FieldSet("_adhoc_repayment_details", ["adhoc_repayment_date", "adhoc_repayment_amount"], array=True),
]

# ---------------------------------------------------------------------------
# Disbursement documents.
# ---------------------------------------------------------------------------
DISBURSEMENT_DEFAULTS = {"transactionChannelId": "settlement"}
DISBURSEMENT_DATETIME_COLS = ["value_date", "booking_date", "first_repayment_date"]
DISBURSEMENT_RENAMES = {
    "loanid": "id",
    "value_date": "valueDate",
    "booking_date": "bookingDate",
    "first_repayment_date": "firstRepaymentDate",
}
DISBURSEMENT_KEYS = ["id", "bookingDate", "valueDate", "firstRepaymentDate"]
DISBURSEMENT_FIELD_SETS = [
    FieldSet("fees", ["predefinedFeeKey", "amount"], array=True),
    FieldSet("transactionDetails", ["transactionChannelId"]),
]
FEE_TYPES = ["Establishment Fee", "Transaction Fees", "Brokerage Fee"]

# ---------------------------------------------------------------------------
# Group documents and roles.
# ---------------------------------------------------------------------------
ROLES = ["primary", "secondary"]

# Placeholder code maps (parameters in practice).
DEFAULT_ROLE_KEYS = {"primary": "role-key-primary", "secondary": "role-key-secondary"}
DEFAULT_FEE_KEYS = {
    "Establishment Fee": "fee-key-establishment",
    "Transaction Fees": "fee-key-transaction",
    "Brokerage Fee": "fee-key-brokerage",
}

# ---------------------------------------------------------------------------
# Type codes of the operational system's tables.
# ---------------------------------------------------------------------------
DATE_TYPE_APPROVED = 2
DATE_TYPE_MATURITY = 4
DATE_TYPE_DISBURSEMENT = 6
RATE_TYPES_BORROWER = [2, 3]
TASK_USERS_FREQUENCY = [
    ([107, 115], "Monthly"),
    ([114, 116], "Fortnightly"),
    ([112, 117], "Weekly"),
]
TASK_USERS_RECURRING = [107, 112, 114, 115, 116, 117]
TASK_USERS_SCHEDULED = [107, 112, 114]
TASK_USER_ONE_OFF = 111
STATUS_PREFIX = "Lender\\"
RATE_MASTER_PREFIX = "Lender\\Provisional Rate\\"

# Placeholder link-type GUIDs (parameters in practice).
DEFAULT_GUIDS = {
    "system_link": "guid-system-link",
    "mobile_contact": "guid-mobile-contact",
    "email_contact": "guid-email-contact",
    "loan_balance": "guid-loan-balance",
    "funder_link": "guid-funder-link",
}
ZERO_GUID = "00000000-0000-0000-0000-000000000000"
