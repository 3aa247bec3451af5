"""Corpus pipeline: toxicity filter, exact dedup, near dedup, benchmark
decontamination, best-fit packing.

``STAGES`` are ``(name, function)`` pairs; each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``.  ``run`` applies them to the
``documents`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bookshift.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from bookshift.llm.common import stage, table

#: least similarity of near copies, in a hundred
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The toxicity scores and the tokenizer are beyond SQL; tests/llm compares
#: every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
