"""Join building blocks.

All are equi-joins the planner can hash-partition (or broadcast when a side
is small), the LIKE join included, so no nested-loop or cartesian plan appears.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: A key with more than one in so many rows of its side is split by ``spread``.
SHARES = 200


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key hash, shares) of the keys that hold over ``1 / SHARES`` of the rows.

    A frequent-items sketch over the keys' hashes: one aggregate with a
    partial phase and a state of fixed size.  At most ``SHARES`` keys come out,
    so the result may always be broadcast.  Null keys count as a key.
    """
    key = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    sketch = df.agg(F.call_function("approx_top_k", key, F.lit(SHARES), F.lit(50 * SHARES)).alias("top"), F.count(F.lit(1)).alias("rows"))
    return (sketch.select("rows", F.inline("top")).where(F.col("count") * SHARES > F.col("rows"))
            .select(F.col("item").alias("key"), F.ceil(F.col("count") * SHARES / F.col("rows")).cast("int").alias("shares")))


def spread(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str], how: str = "inner"
           ) -> tuple[DataFrame, DataFrame, list[tuple[str, str]]]:
    """Both sides of an equi-join with hot keys split, and the pairs of extra
    columns to join by as well.

    The rows of a key that is hot on the left are dealt into shares, and the
    right rows of that key are repeated once a share; likewise the other way
    round.  Every pair of rows meets exactly once, in one of the key's tasks.
    In a left join only left keys are split (repeating left rows would repeat
    those without a partner).
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can be spread")
    hot = hot_keys(left, left_on).withColumnsRenamed({"key": "__hot", "shares": "__ls"}).withColumn("__rs", F.lit(1))
    if how == "inner":
        hot = (hot.unionByName(hot_keys(right, right_on).select(F.col("key").alias("__hot"), F.lit(1).alias("__ls"),
                                                                F.col("shares").alias("__rs")))
               .groupBy("__hot").agg(F.max("__ls").alias("__ls"), F.max("__rs").alias("__rs")))

    def dealt(df: DataFrame, keys: Sequence[str], own: str, other: str, side: str) -> DataFrame:
        row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        marked = df.withColumn("__key", F.xxhash64(*[F.col(f"`{k}`") for k in keys])).join(
            F.broadcast(hot), F.col("__key") == F.col("__hot"), "left")
        many = lambda c: F.coalesce(F.col(c), F.lit(1))
        # the row's hash is the key's as well: mixed once more, so shares do not follow the partitions
        share = F.pmod(F.xxhash64(row, F.lit(side)), many(own)).cast("int")
        return (marked.withColumn(f"__{side}_own", share)
                .withColumn(f"__{side}_met", F.explode(F.sequence(F.lit(0), many(other) - 1)))
                .drop("__key", "__hot", "__ls", "__rs"))

    return (dealt(left, left_on, "__ls", "__rs", "l"), dealt(right, right_on, "__rs", "__ls", "r"),
            [("__l_own", "__r_met"), ("__l_met", "__r_own")])


def merge_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                    suffixes: tuple[str, str] = ("_x", "_y"), spread_hot: bool = False) -> DataFrame:
    """Join on ``on`` where null keys match each other.

    ``eqNullSafe`` still plans as a hash / sort-merge join.  Key columns
    appear once (from the left, or the right when the left is null).
    Other clashing names get ``suffixes``.  With ``spread_hot`` keys that hold a
    large share of a side (all rows without a key, say) are split over tasks
    (see ``spread``).
    """
    on = list(on)
    l_other = [c for c in left.columns if c not in on]
    r_other = [c for c in right.columns if c not in on]
    clash = set(l_other) & set(r_other)
    lsel = [F.col(f"`{c}`").alias(c + suffixes[0] if c in clash else c) for c in l_other]
    rsel = [F.col(f"`{c}`").alias(c + suffixes[1] if c in clash else c) for c in r_other]
    L = left.select(*[F.col(f"`{k}`").alias(f"__l_{k}") for k in on], *lsel)
    R = right.select(*[F.col(f"`{k}`").alias(f"__r_{k}") for k in on], *rsel)
    shares = []
    if spread_hot:
        L, R, shares = spread(L, R, [f"__l_{k}" for k in on], [f"__r_{k}" for k in on], how)
    cond = None
    for k in on:
        c = F.col(f"__l_{k}").eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    for a, b in shares:
        cond = cond & (F.col(a) == F.col(b))
    j = L.join(R, cond, how)
    keys = [F.coalesce(F.col(f"__l_{k}"), F.col(f"__r_{k}")).alias(k) if how in ("right", "full", "outer")
            else F.col(f"__l_{k}").alias(k) for k in on]
    rest = [n for n in j.columns if not n.startswith(("__l_", "__r_"))]
    return j.select(*keys, *[F.col(f"`{n}`") for n in rest])


def merge_chain(base: DataFrame, steps: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Chain of null-safe inner merges on different keys."""
    out = base
    for other, on in steps:
        out = merge_null_safe(out, other, on)
    return out


def role_join(base: DataFrame, base_key: str, table: DataFrame, table_key: str, type_col: str,
              roles: dict[str, object], value_cols: dict[str, str], how: str = "inner") -> DataFrame:
    """Join one table several times, once per type code.

    ``roles`` maps a role prefix to its type code; ``value_cols`` maps a
    table column to an output suffix.  The type test is part of each join
    (for a left join it must not move to WHERE).  Each role's rows are
    pre-filtered on the type code, so the filter is pushed into the scan.
    Duplicated (key, type) pairs multiply rows, as the SQL does.
    """
    out = base
    for role, code in roles.items():
        side = (table.where(F.col(type_col) == F.lit(code))
                .select(F.col(table_key).alias(f"__{role}_k"),
                        *[F.col(c).alias(f"{role}_{suffix}") for c, suffix in value_cols.items()]))
        out = out.join(side, out[base_key] == side[f"__{role}_k"], how).drop(f"__{role}_k")
    return out


_WILD = r"[%_\[]"
#: Code points of the pieces of text that LIKE patterns are looked up by: a
#: pattern takes the greatest width that its longest literal piece has.
_WIDTHS = (0, 1, 2, 3, 5, 8)


def _like_regex(prefix: str, name: Column) -> Column:
    """Regular expression of the T-SQL pattern ``prefix + name``: ``%``, ``_``
    and ``[..]`` classes in the name are wildcards, everything else (a
    backslash, ``!``) is itself; the prefix is literal."""
    text = F.regexp_replace(name, r"([\\.+*?${}()|])", r"\\$1")
    text = F.regexp_replace(text, r"(?<!\[)\^", r"\\^")
    text = F.regexp_replace(text, r"\[(?![^\]]+\])", r"\\[")  # an unclosed bracket is itself
    text = F.replace(F.replace(text, F.lit("%"), F.lit(".*")), F.lit("_"), F.lit("."))
    return F.concat(F.lit("(?s)^" + re.escape(prefix)), text, F.lit("$"))


def _grams(text: Column, width: Column) -> Column:
    """Hashes of all substrings of ``width`` code points; of width 0 the empty one."""
    none = F.array().cast("array<bigint>")
    return F.when(width > F.char_length(text), none).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(text) - width + 1, F.lit(1))),
        lambda i: F.xxhash64(F.substring(text, i, width))))


def _whole(text: Column) -> Column:
    return F.array(F.xxhash64(F.lit("="), text))


def _pattern_grams(prefix: str, name: Column) -> Column:
    """What every text that fits the pattern is listed by: the whole pattern, if
    it has no wildcard, else the substrings of its literal pieces (between
    wildcards), as wide as the longest piece allows."""
    pieces = F.transform(F.split(name, r"%|_|\[[^\]]+\]", -1),
                         lambda p, i: F.when(i == 0, F.concat(F.lit(prefix), p)).otherwise(p))
    longest = F.array_max(F.transform(pieces, F.char_length))
    width = F.array_max(F.filter(F.lit(list(_WIDTHS)), lambda w: w <= longest))
    within = F.array_distinct(F.flatten(F.transform(pieces, lambda p: _grams(p, width))))
    return F.when(name.rlike(_WILD), within).otherwise(_whole(F.concat(F.lit(prefix), name)))


def _like_met(left: DataFrame, left_col: str, names: DataFrame, prefix: str) -> DataFrame:
    """``left`` with a ``__like_name`` column: each row once for each distinct
    name of ``names(__like_name)`` whose pattern its text fits."""
    text, name = F.col(f"`{left_col}`"), F.col("__like_name")
    texts = left.where(text.startswith(prefix)).select(text.alias("__text")).distinct()
    least = max(w for w in _WIDTHS if w <= len(prefix))  # a pattern's longest piece holds the prefix
    listed = texts.select(F.xxhash64("__text").alias("__id"), F.explode(F.array_distinct(F.concat(
        _whole(F.col("__text")), *[_grams(F.col("__text"), F.lit(w)) for w in _WIDTHS if w >= least]))).alias("gram")
    ).hint("merge")  # far more rows than estimated
    held = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = (names.distinct().select(name, F.explode(_pattern_grams(prefix, name)).alias("gram")).hint("merge")
              .join(held, "gram", "left").groupBy("__like_name")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "gram"))["gram"].alias("gram")))
    near = listed.join(rarest, "gram").select("__id", "__like_name").distinct()
    fits = F.when(name.rlike(_WILD), F.rlike(text, _like_regex(prefix, name))).otherwise(text == F.concat(F.lit(prefix), name))
    return left.join(near, F.xxhash64(text) == F.col("__id")).where(fits).drop("__id")


def like_join(left: DataFrame, left_col: str, right: DataFrame, prefix: str, right_col: str,
              how: str = "inner") -> DataFrame:
    """Inner join where ``left_col LIKE concat(prefix, right_col)``.

    ``%``, ``_`` and ``[..]`` inside names are wildcards, as in T-SQL; there is
    no escape character, and a null name reads as an empty one.

    Patterns, those with a leading wildcard included, go through an index of
    q-grams: each distinct text is listed by its substrings of the widths in
    ``_WIDTHS`` and as a whole (by hashes, the text itself is not repeated).  A
    pattern without wildcards is looked up as a whole, any other by the rarest
    substring among its literal pieces, as wide as they allow; the texts found
    there are tested by the pattern.  A pattern without any literal piece has
    the empty substring and meets every text.  All joins are equi-joins, at any
    size.
    """
    if how != "inner":
        raise ValueError("like_join supports inner joins")
    read = lambda df, c: F.coalesce(df[c], F.lit(""))
    met = _like_met(left, left_col, right.select(read(right, right_col).alias("__like_name")), prefix)
    return met.join(right, read(right, right_col) == F.col("__like_name")).drop("__like_name")


def like_matches(details: DataFrame, detail_col: str, rows: DataFrame, prefix: str, name_col: str,
                 names: DataFrame | None = None) -> DataFrame:
    """``rows`` joined to every ``details`` row whose text is LIKE prefix + name.

    The pattern test runs once per distinct name (funder or product names),
    and the matches are joined back to the rows by equality, so the large
    side only takes part in a hash join.  ``names`` is a table that holds
    every name of ``rows`` (in ``name_col``), if there is one cheaper to
    read.  Multiplicities are those of the direct LIKE join.
    """
    source = rows if names is None else names
    matched = _like_met(details, detail_col, source.select(F.coalesce(F.col(name_col), F.lit("")).alias("__like_name")), prefix)
    return rows.join(matched, F.coalesce(rows[name_col], F.lit("")) == matched["__like_name"]).drop("__like_name")


def others_in_group(df: DataFrame, group: str, key: str, value: str, count_name: str, total_name: str) -> DataFrame:
    """``df`` joined to the rows of the same ``group`` with another
    ``key``, summed up per (key, group): how many there are and the total of
    their ``value``.

    The rows are added up by key first; what the others hold is the group's
    sums less the key's own, so no key's rows are paired with another's.  As
    in the join, a row stands once for each of its key's rows, a null group
    or key has no partners, keys without partners have no row, and the total
    is null where no partner has a value.
    """
    own = (df.where(F.col(group).isNotNull() & F.col(key).isNotNull()).groupBy(group, key)
           .agg(F.count(F.lit(1)).alias("__n"), F.count(value).alias("__v"),
                F.coalesce(F.sum(value), F.lit(0)).alias("__s")))
    whole = own.groupBy(group).agg(F.sum("__n").alias("__gn"), F.sum("__v").alias("__gv"), F.sum("__s").alias("__gs"))
    others = F.col("__gn") - F.col("__n")
    total = F.when(F.col("__gv") > F.col("__v"), (F.col("__gs") - F.col("__s")) * F.col("__n"))
    return (own.join(whole, group).where(others > 0)
            .select(key, group, (others * F.col("__n")).alias(count_name), total.alias(total_name)))


def join_by_seq(left: DataFrame, right: DataFrame, seq: str = "seq", how: str = "inner",
                suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Attach two row sets that describe the same requests.

    The original attached them by row position; here both sides carry the
    request key ``seq`` and are joined on it, which gives the same pairs
    without relying on row order.  Clashing names get ``suffixes``.
    """
    clash = (set(left.columns) & set(right.columns)) - {seq}
    L = left.select(*[F.col(f"`{c}`").alias(c + suffixes[0] if c in clash else c) for c in left.columns])
    R = right.select(*[F.col(f"`{c}`").alias(c + suffixes[1] if c in clash else c) for c in right.columns])
    return L.join(R, on=seq, how=how)
