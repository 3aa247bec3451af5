"""Scalar column functions: casts, strings, conditionals, null clean-up.

Each one is a plain expression over built-in functions, so it runs inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- casts (S1-S4) -------------------------------------------------------------

def to_int(c: str | Column, lenient: bool = False) -> Column:
    """Text -> INT.  ANSI mode fails on text such as ``''``; ``lenient`` gives null."""
    return _c(c).try_cast("int") if lenient else _c(c).cast("int")


def to_bigint(c: str | Column, lenient: bool = False) -> Column:
    return _c(c).try_cast("bigint") if lenient else _c(c).cast("bigint")


def to_date(c: str | Column) -> Column:
    return _c(c).cast("date")


def date_text(c: str | Column, null_text: str | None = "None") -> Column:
    """Date -> text; a null date becomes ``null_text`` (P11: the grouping then keeps it)."""
    t = _c(c).cast("string")
    return t if null_text is None else F.coalesce(t, F.lit(null_text))


# -- strings (S5-S8) -----------------------------------------------------------

def remove_text(c: str | Column, search: str) -> Column:
    """Two-argument REPLACE: remove every occurrence of ``search``."""
    return F.replace(_c(c), F.lit(search), F.lit(""))


def replace_text(c: str | Column, search: str, repl: str) -> Column:
    return F.replace(_c(c), F.lit(search), F.lit(repl))


def strip_dashes(c: str | Column) -> Column:
    """GUID with dashes -> 32 hex characters."""
    return replace_text(c, "-", "")


def concat_tsql(*cols: str | Column) -> Column:
    """CONCAT with SQL Server semantics: a null argument counts as ``''``."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def quote_id(c: str | Column) -> Column:
    """``5`` -> ``'5'`` (S7 with S4)."""
    return F.concat(F.lit("'"), _c(c).cast("string"), F.lit("'"))


def basic_auth(user: str | Column, password: str | Column) -> Column:
    """``base64('user:password')`` for an Authorization header column."""
    return F.base64(F.concat_ws(":", _c(user), _c(password)).cast("binary"))


# -- conditionals (S9-S11) -----------------------------------------------------

def case_in_lists(c: str | Column, cases: Sequence[tuple[Sequence, object]]) -> Column:
    """CASE WHEN c IN (..) THEN v ... END, no ELSE (null when nothing matches)."""
    expr = None
    for values, result in cases:
        cond = _c(c).isin(list(values))
        expr = F.when(cond, F.lit(result)) if expr is None else expr.when(cond, F.lit(result))
    return expr


def iff(cond: Column, then, otherwise) -> Column:
    """IFF: a null condition takes the else branch."""
    t = then if isinstance(then, Column) else F.lit(then)
    o = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.when(F.coalesce(cond, F.lit(False)), t).otherwise(o)


# -- null clean-up (S16, P10) --------------------------------------------------

def nan_to_null(c: str | Column) -> Column:
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def normalise_nulls(df: DataFrame) -> DataFrame:
    """Every float/double NaN -> null; other columns unchanged."""
    fixes = {f.name: nan_to_null(F.col(f"`{f.name}`")).cast(f.dataType)
             for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.withColumns(fixes) if fixes else df


# -- dictionary lookups (J16, P13) ---------------------------------------------

def lookup(c: str | Column, mapping: Mapping[str, str], strict: bool = False,
           lower: bool = False, what: str = "code") -> Column:
    """Map a code to a key with a literal map.

    ``lower`` lower-cases the code first (roles); fee types are exact.  With
    ``strict`` an unknown code raises an error naming it (the original raised
    a key error); otherwise it gives null, and ``unmapped_rows`` lists them.
    """
    key = F.lower(_c(c).cast("string")) if lower else _c(c).cast("string")
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.try_element_at(m, key)
    if not strict:
        return found
    return F.coalesce(found, F.raise_error(F.concat(F.lit(f"unmapped {what}: "),
                                                    F.coalesce(key, F.lit("null")))).cast("string"))


def unmapped_rows(df: DataFrame, c: str, mapping: Mapping[str, str], lower: bool = False) -> DataFrame:
    """Rows whose code has no key in the map (Q3).  The map is a literal
    expression, so no join or broadcast is needed."""
    key = F.lower(F.col(c).cast("string")) if lower else F.col(c).cast("string")
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.where(~F.map_contains_key(m, key) | key.isNull())
