"""From a cohort of loan ids to the rows the documents are built from.

A cohort is a DataFrame with a ``loanid`` column (duplicates and nulls do not
matter).  It cuts the tables that name the loans before anything is joined,
so the joins read the cohort's rows only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookshift.plans import datasets, documents

#: tables that name loans: their loan id column
LOAN_ID = {
    "io_keys_masterreference": "ymr_idlink_foreign",
    "application_security": "loanid",
}


def _kept(df: DataFrame, column: str, cohort: DataFrame) -> DataFrame:
    ids = cohort.select(F.col("loanid").cast(df.schema[column].dataType).alias("__loan"))
    return df.join(ids, F.col(column) == F.col("__loan"), "left_semi")


def for_cohort(t: Mapping[str, DataFrame], cohort: DataFrame) -> dict[str, DataFrame]:
    """The source tables with the loans of the cohort only.  The application
    view stays whole: other loans of an application name secondary applicants."""
    return {name: _kept(df, LOAN_ID[name], cohort) if name in LOAN_ID else df for name, df in t.items()}


def clients(t: Mapping[str, DataFrame], cohort: DataFrame) -> DataFrame:
    """Staged client rows (K1, and the members of K2) of the cohort's loans."""
    applicants = _kept(datasets.applicants_by_role(t), "loanid", cohort)
    return documents.client_staged(applicants, datasets.client_details_operational(for_cohort(t, cohort)))


def loans(t: Mapping[str, DataFrame], cohort: DataFrame, funders: DataFrame, group_keys: DataFrame,
          test_group: str, by_loan: bool = False) -> DataFrame:
    """Staged loan rows (K3) of the cohort (``by_loan``: see ``documents.loan_staged``)."""
    own = for_cohort(t, cohort)
    attributes = _kept(datasets.loan_attributes(own), "loanid", cohort)
    return documents.loan_staged(datasets.loan_accounts_operational(own), attributes, funders, group_keys, test_group,
                                 by_loan)


def disbursements(t: Mapping[str, DataFrame], cohort: DataFrame) -> DataFrame:
    """Fee rows (K4) of the cohort's disbursements."""
    return datasets.disbursement_details(for_cohort(t, cohort))
