"""Document builders: client (K1), group (K2), loan (K3), disbursement (K4).

Each takes a *staged* DataFrame (the reconciled rows, see ``datasets``),
applies renames, defaults and date stamps, and nests it with one
``groupBy``.  The result has one row per document key plus ``copies``;
``payloads`` turns it into ``(id, copies, payload)`` JSON text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookshift.functions.jsonio import JSON_OPTS
from bookshift.functions.scalars import date_text, lookup, normalise_nulls
from bookshift.functions.temporal import tz_stamp
from bookshift.operators.joins import merge_chain, merge_null_safe
from bookshift.operators.nest import FieldSet, QualityCounts, nest_counted, nest_field_sets, quarantine_null_keys
from bookshift.plans import specs


def constant_columns(defaults: Mapping[str, object]) -> dict[str, Column]:
    """Default map -> literal Columns (``None`` is a typed null double)."""
    return {k: (F.lit(None).cast("double") if v is None else F.lit(v)) for k, v in defaults.items()}


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add constant columns (B5); ``None`` becomes a typed null double."""
    cols = {}
    for k, v in defaults.items():
        cols[k] = F.lit(None).cast("double") if v is None else F.lit(v)
    return df.withColumns(cols)


def stamp_columns(df: DataFrame, cols: Sequence[str], zone: str = "Australia/Sydney") -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: tz_stamp(F.col(c), zone) for c in present}) if present else df


def rename_existing(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename by map; names not present are ignored (B2)."""
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def payloads(nested: DataFrame, id_col: str = "id", copies_col: str = "copies",
             exclude: Sequence[str] = ()) -> DataFrame:
    """``(id, copies, payload)``: the document without ``copies`` as JSON."""
    skip = [copies_col, *exclude]
    body_cols = sorted(c for c in nested.columns if c not in skip)
    body = F.struct(*[F.col(f"`{c}`") for c in body_cols])
    keep = [F.col(id_col).alias("id")] + [F.col(c) for c in (copies_col,) if c in nested.columns]
    return nested.select(*keep, F.to_json(body, JSON_OPTS).alias("payload"))


# -- K1 --------------------------------------------------------------------------

def client_staged(applicants: DataFrame, details: DataFrame) -> DataFrame:
    """Applicants by role (K8) merged with borrower details (K7) on loan id and
    birth date; null keys match (J4, P1)."""
    return merge_null_safe(applicants, details, ["loanid", "birthdate"])


def client_master(staged: DataFrame, null_date_text: str | None = "None") -> DataFrame:
    """Client staged rows renamed to document names, birth date as text (P11), NaN -> null."""
    master = rename_existing(staged, specs.CLIENT_RENAMES)
    master = master.withColumn("birthDate", date_text("birthDate", null_date_text))
    return normalise_nulls(master)


def client_quarantine(staged: DataFrame, null_date_text: str | None = "None") -> DataFrame:
    """Client staged rows that ``client_documents`` leaves out because a key
    is null (P2: e.g. a missing middle name), with the null key names (Q1)."""
    return quarantine_null_keys(client_master(staged, null_date_text), specs.CLIENT_KEYS)


def client_documents(staged: DataFrame, order_by: Sequence[str | Column],
                     null_keys: str = "drop", null_date_text: str | None = "None") -> DataFrame:
    """K1: one client document per distinct client key tuple.

    Birth date becomes text before grouping, so a null date reads ``None``
    and is kept (P11); other null keys drop the row (P2, see
    ``quarantine_null_keys``).
    """
    master = client_master(staged, null_date_text)
    return nest_field_sets(master, specs.CLIENT_KEYS, specs.CLIENT_FIELD_SETS, order_by, null_keys)


def client_documents_counted(staged: DataFrame, order_by: Sequence[str | Column],
                             null_date_text: str | None = "None") -> tuple[DataFrame, QualityCounts]:
    """K1 with its quality counts (rows without a key, entities with several
    rows) from the execution that writes the documents."""
    return nest_counted(client_master(staged, null_date_text), specs.CLIENT_KEYS, specs.CLIENT_FIELD_SETS, order_by, "client")


# -- K2 --------------------------------------------------------------------------

def group_documents(clients_fetched: DataFrame, role_keys: Mapping[str, str] = specs.DEFAULT_ROLE_KEYS,
                    order_by: Sequence[str | Column] = ("seq",), strict: bool = True) -> DataFrame:
    """K2: one group per loan: ``groupName`` and ``id`` (both the loan id) and
    ``groupMembers`` = every member ``{clientKey, roles: [{groupRoleNameKey}]}``
    in staged order, unpruned.

    ``clients_fetched`` has ``loanid``, ``encodedKey`` (the client's API key)
    and ``application_role``.  An unknown role fails in strict mode (P13).
    """
    role_key = lookup("application_role", role_keys, strict=strict, lower=True, what="role")
    members = clients_fetched.select(
        "*", F.col("encodedKey").alias("clientKey"),
        F.array(F.struct(role_key.alias("groupRoleNameKey"))).alias("roles"))
    sets = [FieldSet("groupMembers", ["clientKey", "roles"], array=True, prune=False)]
    nested = nest_field_sets(members, ["loanid"], sets, order_by, "drop")
    return nested.select(F.col("loanid").alias("groupName"), F.col("loanid").alias("id"), "groupMembers")


def group_payloads(groups: DataFrame) -> DataFrame:
    """Group documents as JSON, keys in the order groupName, id, groupMembers."""
    body = F.struct("groupName", "id", "groupMembers")
    return groups.select("id", F.size("groupMembers").cast("bigint").alias("n_members"), F.to_json(body, JSON_OPTS).alias("payload"))


# -- K3 --------------------------------------------------------------------------

def loan_staged(loan_accounts: DataFrame, loan_attributes: DataFrame, funders: DataFrame,
                group_keys: DataFrame, test_group: str, by_loan: bool = False) -> DataFrame:
    """Loan accounts (K9) + loan attributes (K10) on loan id, + funder keys
    on funder name, + group keys on loan id (J5); then the run tag and a
    whole-row de-duplication (G5).

    With ``by_loan`` a loan's rows are brought together before the
    de-duplication, which with ``loan_documents`` then needs no other shuffle:
    for rows that are nested whole.  Without it a large loan's rows stay
    spread, for the uncollected forms of ``nest``."""
    merged = merge_chain(loan_accounts, [(loan_attributes, ["loanid"]), (funders, ["funder"]),
                                         (group_keys, ["loanid"])])
    if by_loan:
        merged = merged.repartition("loanid")
    return merged.withColumn("test_group", F.lit(test_group)).dropDuplicates()


def loan_documents(staged: DataFrame, order_by: Sequence[str | Column],
                   defaults: Mapping[str, object] = specs.LOAN_DEFAULTS, null_keys: str = "drop",
                   zone: str = "Australia/Sydney") -> DataFrame:
    """K3: zone stamps, renames, NaN -> null, then 7 field sets; the product
    defaults are constants attached after the aggregation (not carried
    through the shuffle)."""
    df = stamp_columns(staged, specs.LOAN_DATETIME_COLS, zone)
    df = rename_existing(df, specs.LOAN_RENAMES)
    if "funder" in df.columns:
        df = df.drop("funder")
    df = normalise_nulls(df.drop(*[c for c in defaults if c in df.columns]))
    return nest_field_sets(df, specs.LOAN_KEYS, specs.LOAN_FIELD_SETS, order_by, null_keys,
                           constants=constant_columns(defaults))


# -- K4 --------------------------------------------------------------------------

def disbursement_documents(staged: DataFrame, order_by: Sequence[str | Column],
                           fee_keys: Mapping[str, str] = specs.DEFAULT_FEE_KEYS, strict: bool = True,
                           defaults: Mapping[str, object] = specs.DISBURSEMENT_DEFAULTS,
                           zone: str = "Australia/Sydney", null_keys: str = "drop") -> DataFrame:
    """K4: fee key lookup (exact match), channel default, zone stamps,
    renames, then ``fees`` (array) and ``transactionDetails`` (object); one
    document per key (P8 off: ``copies`` is 1)."""
    df = staged
    if null_keys == "drop":
        # The stamped keys are null exactly when their source columns are, so
        # the null-key rule is applied to the source columns: a filter on the
        # stamped text would be pushed below the stamp and computed twice.
        raw_keys = [k for k, v in specs.DISBURSEMENT_RENAMES.items() if v in specs.DISBURSEMENT_KEYS]
        df = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in raw_keys)))
    df = df.withColumn("predefinedFeeKey", lookup("fee_type", fee_keys, strict=strict, what="fee type"))
    df = stamp_columns(df, specs.DISBURSEMENT_DATETIME_COLS, zone)
    df = rename_existing(df, specs.DISBURSEMENT_RENAMES).drop("fee_type")
    df = normalise_nulls(df.drop(*[c for c in defaults if c in df.columns]))
    nested = nest_field_sets(df, specs.DISBURSEMENT_KEYS, specs.DISBURSEMENT_FIELD_SETS, order_by, "keep",
                             constants=constant_columns(defaults))
    return nested.withColumn("copies", F.lit(1).cast("bigint"))


__all__ = [
    "client_master", "client_quarantine", "constant_columns", "with_defaults", "stamp_columns", "rename_existing", "payloads", "client_staged", "client_documents", "client_documents_counted",
    "group_documents", "group_payloads", "loan_staged", "loan_documents", "disbursement_documents",
]
