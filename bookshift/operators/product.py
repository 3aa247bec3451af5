"""Rows of one key laid out side by side, without holding a key's rows together.

Several joins of one table to the same key (a loan's recurring, scheduled and
one-off tasks) give, per key, the product of the sides' rows.  ``beside``
takes the sides from one pass over the table and gathers a key's rows in one
row, unless it is told the size of a block.  Then only keys of few rows are
gathered whole.  The sides of larger keys are cut into blocks of about that
size; every combination of a key's blocks has an address, a number in mixed
radix whose digits are the block of each side.  A row goes to all addresses
that have its block in its side's digit, and each address is gathered like a
key of few rows, by the same aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _laid_out(df: DataFrame, keep: Sequence[str], sides: Sequence[str], outer: bool) -> DataFrame:
    """The product of the list columns ``__<side>`` of each row."""
    out, done = df.select(*keep, *[f"__{s}" for s in sides]), list(keep)
    for k, s in enumerate(sides):
        rest = [f"__{x}" for x in sides[k + 1:]]
        out = out.select(*done, *rest, (F.inline_outer if outer else F.inline)(f"__{s}"))
        done = [c for c in out.columns if c not in rest]
    return out


def beside(df: DataFrame, key: str, sides: Mapping[str, tuple[Column, Column]], outer: bool,
           block_rows: int | None = None) -> DataFrame:
    """One row per key and combination of one row of each side.

    A side is ``(condition, struct or array of structs)`` over the columns of
    ``df``; a row may belong to several sides, and an array adds each of its
    elements.  With ``outer`` a side without rows gives nulls, else it drops
    the key.  Repeated rows count as often as they stand; a null key is a key
    like any other here (it meets nothing in an equi-join).

    Without ``block_rows`` there is one aggregate and one read of ``df``.  With
    it ``df`` is read once more to size the keys, the result is the same, and
    no task holds more than a block of each side: for keys too large for one
    row.  Which one to use is the caller's choice; no size decides it.
    """
    names = list(sides)
    kinds = {s: df.select(v.alias("v")).schema["v"].dataType for s, (_, v) in sides.items()}
    many = {s: isinstance(kinds[s], T.ArrayType) for s in names}
    listed = {s: T.ArrayType(kinds[s].elementType if many[s] else kinds[s]) for s in names}

    # null where a row is not of the side: such rows take no room in the lists
    own = df.select(F.col(f"`{key}`").alias("__key"), *[
        F.when(test, v if many[s] else F.array(v)).cast(listed[s]).alias(f"__{s}") for s, (test, v) in sides.items()])
    gather = [F.flatten(F.collect_list(f"__{s}")).alias(f"__{s}") for s in names]
    if block_rows is None:
        return _laid_out(own.groupBy("__key").agg(*gather), ["__key"], names, outer).withColumnRenamed("__key", key)
    sizes = own.groupBy("__key").agg(
        *[F.sum(F.coalesce(F.array_size(f"__{s}"), F.lit(0)).cast("long")).alias(f"n_{s}") for s in names])
    large = sizes.where(F.greatest(*[F.col(f"n_{s}") for s in names]) > block_rows).select(
        F.col("__key").alias("__big"),
        F.array(*[F.col(f"n_{s}") > 0 for s in names]).alias("__need"),
        *[F.greatest(F.ceil(F.col(f"n_{s}") / block_rows), F.lit(1)).cast("long").alias(f"b_{s}") for s in names])

    # a row of a key that is gathered whole goes to its only address; one of a large key is cut into its elements
    total = F.lit(1).cast("long")
    stride = {}
    for s in names:
        stride[s], total = total, total * F.col(f"b_{s}")

    def elements(s: str) -> Column:
        def placed(x: Column) -> Column:
            alone = [(F.array(x) if t == s else F.lit(None)).cast(listed[t]).alias(f"__{t}") for t in names]
            return F.struct(F.pmod(F.xxhash64(x), F.col(f"b_{s}")).alias("block"), F.col(f"b_{s}").alias("blocks"),
                            stride[s].alias("stride"), F.floor(total / F.col(f"b_{s}")).cast("long").alias("copies"), *alone)
        return F.transform(F.coalesce(f"__{s}", F.array().cast(listed[s])), placed)

    one = F.lit(1).cast("long")
    whole_row = F.struct(F.lit(0).cast("long").alias("block"), one.alias("blocks"), one.alias("stride"),
                         one.alias("copies"), *[F.col(f"__{s}") for s in names])
    parts = F.when(F.col("__need").isNull(), F.array(whole_row)).otherwise(F.concat(*[elements(s) for s in names]))
    # the address without its side's digit counts through the copies; the digit is put in its place
    address = F.expr("(copy DIV stride) * (stride * blocks) + block * stride + copy % stride")
    gathered = (own.join(large, F.col("__key").eqNullSafe(F.col("__big")), "left").select("__key", "__need", F.inline(parts))
                .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
                .groupBy("__key", "__need", address.alias("__address")).agg(*gather))
    # a block no element fell into has no rows, a side without elements is laid out as empty
    for k, s in enumerate(names):
        gathered = gathered.where(~F.coalesce(F.col("__need")[k], F.lit(False)) | (F.size(f"__{s}") > 0))
    return _laid_out(gathered, ["__key"], names, outer).withColumnRenamed("__key", key)
