"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import string
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch.  A batch is held in memory whole, and single texts can
#: be megabytes long, so batches are kept smaller than Spark's default.
ARROW_ROWS = 1000

#: Everything in ASCII that is neither a letter nor a digit separates words.
WORD_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Prepare a session for functions on batches of whole texts: lower its
    Arrow batch size, and let Python workers find this package where the driver
    found it (a package shipped with the job is found before that)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), home)))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only for a
    local master that has none set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-stage-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors; what is written
    once is computed once, so row numbers taken in it stay as they are.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_up_to(df: DataFrame, rows: int, row_bytes: int, max_bytes: int = 32 << 20) -> DataFrame:
    """A broadcast hint if ``rows`` known rows of ``row_bytes`` stay under
    ``max_bytes``; beyond that the planner shuffles both sides."""
    return F.broadcast(df) if rows * row_bytes <= max_bytes else df


#: A join key that holds more than one in so many rows is split.
SHARES = 1000


def hot_keys(held: DataFrame, on: list[str], rows: str, total: int) -> DataFrame:
    """Keys of ``held`` (one row a key, ``rows`` rows of ``total`` on the
    joined side) that hold over ``1 / SHARES`` of all rows, with the number of
    shares to split them into.  There are fewer than ``SHARES`` such keys and
    fewer than ``2 * SHARES`` shares at any size."""
    return held.filter(F.col(rows) * SHARES > total).select(
        *on, F.ceil(F.col(rows) * SHARES / F.lit(max(total, 1))).cast("int").alias("__shares"))


def split_rows(df: DataFrame, hot: DataFrame, on: list[str], by: list[str]) -> DataFrame:
    """``df`` with a ``__share`` column: rows of a hot key are dealt out by ``by``."""
    marked = df.join(F.broadcast(hot), on, "left")
    return marked.withColumn("__share", F.coalesce(F.pmod(F.xxhash64(*by), F.col("__shares")), F.lit(0))
                             .cast("int")).drop("__shares")


def repeat_rows(df: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    """The other side of :func:`split_rows`: a row of a hot key once a share."""
    marked = df.join(F.broadcast(hot), on, "left")
    return marked.withColumn("__share", F.explode(F.sequence(F.lit(0), F.coalesce("__shares", F.lit(1)) - 1))).drop("__shares")


#: ASCII white space; what stands between it is a word here.
BLANKS = r"[\x20\x09-\x0D]+"


def blank_words(text: Column) -> Column:
    """Array of what stands between ASCII white space, unchanged; null text
    gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Array of lower-cased words (ASCII letters and digits, any other
    character outside ASCII); null or word-free text gives an empty array."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAK, -1), "")


def texts(column) -> Iterator[bytes]:
    """UTF-8 bytes of each value of an Arrow string column; null is empty."""
    import pyarrow as pa

    for chunk in getattr(column, "chunks", [column]):
        for value in chunk.cast(pa.binary()).to_pylist():
            yield value or b""
