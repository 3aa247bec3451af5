"""Named datasets (A4): a name stands for a builder over source tables.

``build(name, tables)`` is what a caller uses instead of a file of SQL text;
``needs(name)`` lists the tables to load for it.  ``with_cohort`` keeps a
result to a list of loan ids, as the queries of the source systems did with
their filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame

from bookshift.plans import datasets
from bookshift.sources.tables import filter_cohort_ids, semi_join_cohort


class Dataset(NamedTuple):
    build: Callable[..., DataFrame]
    tables: tuple[str, ...]
    key: str


DATASETS: dict[str, Dataset] = {
    "client_details_operational": Dataset(datasets.client_details_operational, (
        "io_client_addressdetail", "io_client_contactdetail", "io_client_masterreference", "io_client_typeindividual",
        "io_control_clientgender", "io_control_clienttitle", "io_keys_masterreference", "io_link_masterreference",
        "io_product_masterreference"), "loanid"),
    "applicants_by_role": Dataset(datasets.applicants_by_role, ("application_loans",), "loanid"),
    "loan_accounts_operational": Dataset(datasets.loan_accounts_operational, (
        "io_client_bankdetail", "io_client_masterreference", "io_control_productbalance", "io_control_productratemaster",
        "io_control_statusmaster", "io_control_taskmaster", "io_keys_masterreference", "io_link_masterreference",
        "io_product_controlbalance", "io_product_controldate", "io_product_controlrate", "io_product_loanmdt",
        "io_product_loantransfer", "io_product_masterreference", "io_task_pending"), "loanid"),
    "loan_attributes": Dataset(datasets.loan_attributes, ("application_loans", "application_security"), "loanid"),
    "disbursement_details": Dataset(datasets.disbursement_details, (
        "io_control_transactionmaster", "io_keys_masterreference", "io_product_controldate", "io_product_transaction"), "loanid"),
    "multi_adhoc": Dataset(datasets.multi_adhoc, (
        "io_control_taskmaster", "io_keys_masterreference", "io_task_pending"), "ymr_idlink_foreign"),
    "test_cohort": Dataset(datasets.test_cohort, (
        "application_loans", "loan_status_report", "warehouse_keys_masterreference", "warehouse_product_transaction"), "loan_id"),
}


def names() -> list[str]:
    return sorted(DATASETS)


def _entry(name: str) -> Dataset:
    if name not in DATASETS:
        raise KeyError(f"no dataset {name!r}; there are {', '.join(names())}")
    return DATASETS[name]


def needs(name: str) -> tuple[str, ...]:
    """Tables a dataset is built from."""
    return _entry(name).tables


def build(name: str, tables: Mapping[str, DataFrame], **options) -> DataFrame:
    """The dataset of that name over ``tables`` (name -> DataFrame)."""
    entry = _entry(name)
    missing = [t for t in entry.tables if t not in tables]
    if missing:
        raise KeyError(f"{name} needs the tables {', '.join(missing)}")
    return entry.build(tables, **options)


def with_cohort(name: str, tables: Mapping[str, DataFrame], cohort: DataFrame | Iterable, **options) -> DataFrame:
    """The dataset kept to a cohort: a list of ids, or a DataFrame whose only
    column holds them."""
    out, key = build(name, tables, **options), _entry(name).key
    if isinstance(cohort, DataFrame):
        ids = cohort.select(cohort[cohort.columns[0]].cast(out.schema[key].dataType).alias(key))
        return semi_join_cohort(out, ids, key)
    return filter_cohort_ids(out, key, cohort)
