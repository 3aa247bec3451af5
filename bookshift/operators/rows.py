"""Row-level operators: de-duplication, keep-first, top-N per group, sequences
(G4-G6, W1-W3, F10).

None of them moves a whole group into one task when a partial form exists:

* keep-first is ``min_by`` over a struct, a partial aggregate;
* top-N per group uses ``row_number`` + filter, which Spark plans with a
  map-side ``WindowGroupLimit``, so a hot group is cut to N rows per map
  task before the shuffle;
* a global sequence is built from range partitions and per-partition counts,
  never from a window without a partition key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication; null equals null."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the lowest ``order_by``.

    ``dropDuplicates(subset)`` keeps an arbitrary row; this keeps the first
    in the declared order, with a partial aggregate (no window, no sort of
    the whole group).
    """
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(order_by))])
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    out = df.groupBy(*keys).agg(F.min_by(row, order).alias("__first"))
    return out.select(*keys, *[F.col("__first").getField(c).alias(c) for c in others])


def top_n_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Column], n: int,
                    rank_col: str = "rn") -> DataFrame:
    """ROW_NUMBER() per group under an explicit order, keep ``rank_col <= n``
    (W1, W2, F10).  Give null ordering explicitly (``asc_nulls_last`` etc.)
    and a unique tie-break last, so the cut is deterministic."""
    w = Window.partitionBy(*group).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


#: Sampled rows for each range.
_SAMPLE = 100


def _plain(kind: T.DataType):
    """(to, back): a column of a type as a value the driver can hold exactly,
    and the literal it comes back as."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros, lambda v: F.timestamp_micros(F.lit(v).cast("bigint"))
    if isinstance(kind, T.DateType):
        return F.unix_date, lambda v: F.date_from_unix_date(F.lit(v).cast("int"))
    if isinstance(kind, (T.TimestampNTZType, T.DecimalType)):
        return lambda c: c.cast("string"), lambda v: F.lit(v).cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.hex, lambda v: F.unhex(F.lit(v))
    return lambda c: c, lambda v: F.lit(v).cast(kind)


def range_cuts(df: DataFrame, order_by: Sequence[str], ranges: int) -> list[list[Column]]:
    """Splitters that cut ``df`` into ``ranges`` ranges of about equal size in
    the order of all columns of ``order_by``.

    They are taken from an even sample (``_SAMPLE`` rows a range, the least of a
    random number: a partial top-k, whatever the number of rows), so a leading
    value that many rows share is cut by the columns after it.  Every type
    that can be sorted will do; nulls come first.
    """
    ways = [_plain(df.schema[c].dataType) for c in order_by]
    sample = (df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order_by)], F.rand(17).alias("r"))
              .orderBy("r").limit(ranges * _SAMPLE))
    keys = [f"k{i}" for i in range(len(order_by))]
    found = sample.orderBy(*keys).select(*[to(F.col(k)).alias(k) for k, (to, _) in zip(keys, ways)]).collect()
    cuts = list(dict.fromkeys(tuple(found[len(found) * i // ranges]) for i in range(1, ranges))) if found else []
    return [[back(v) for v, (_, back) in zip(cut, ways)] for cut in cuts]


def range_of(order_by: Sequence[str], cuts: list[list[Column]]) -> Column:
    """The number of a row's range: how many cuts are at or below it, counted
    over blocks first and then within one, so a row is compared with about
    ``2 * sqrt(cuts)`` of them."""
    if not cuts:
        return F.lit(0)
    names = [f"c{i}" for i in range(len(order_by))]
    key = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(order_by, names)])
    literal = lambda cut: F.struct(*[v.alias(n) for v, n in zip(cut, names)])
    step = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    at_or_below = lambda of: F.size(F.filter(of, lambda c: c <= key))
    block = at_or_below(F.array(*[literal(b[0]) for b in blocks]))
    within = F.get(F.array(*[F.array(*[literal(c) for c in b]) for b in blocks]), block - 1)
    return F.when(block == 0, 0).otherwise((block - 1) * step + at_or_below(within))


def row_sequence(df: DataFrame, order_by: Sequence[str], name: str = "seq", start: int = 0,
                 buckets: int | None = None) -> DataFrame:
    """Number rows ``start, start+1, ...`` in a total ``order_by`` order.

    Splitters over all order columns (``range_cuts``, one sampling job) cut the
    rows into ranges of about equal size, one partition each; rows are numbered
    within their range, and a range's first number is the row count of the
    ranges before it.  Both read ``df`` itself, nothing is written.  Rows that
    share the leading value are cut by the columns after it; nulls come first.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("__range", range_of(order_by, range_cuts(df, order_by, n)))
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__range", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))  # at most ``buckets`` rows
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*[F.col(f"`{c}`") for c in order_by])) - 1
    # every range has an offset; a left join keeps the range number from being worked out once more for a null test
    out = ranged.repartitionById(n, "__range").withColumn("__place", place).join(F.broadcast(offsets), "__range", "left")
    return out.select((F.lit(start) + F.col("__off") + F.col("__place")).cast("bigint").alias(name),
                      *[F.col(f"`{c}`") for c in df.columns])
