"""JSON in and out.

Documents are ``to_json`` over structs whose field names are sorted at every
level, so the text has sorted keys; ``to_json`` leaves out null fields.
Flattening turns a nested value into ``a_b_0_c`` columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_OPTS = {"ignoreNullFields": "true"}


def sorted_struct(*cols: str | Column, names: list[str] | None = None) -> Column:
    """struct(...) with the fields in name order.

    ``cols`` are column names, or Columns with ``names`` giving their names.
    """
    if names is None:
        names = [c for c in cols]
        cols = [F.col(c) for c in cols]
    pairs = sorted(zip(names, cols), key=lambda p: p[0])
    return F.struct(*[c.alias(n) for n, c in pairs])


def payload_json(df: DataFrame, key_cols: list[str], doc_col: str = "payload",
                 exclude: list[str] | None = None) -> DataFrame:
    """Row -> ``(keys..., payload)`` where payload is the row as a JSON object.

    Top-level null attributes are left out (S17), keys are sorted (P9/O2).
    Nested structs are expected to be built with sorted fields already
    (``nest_field_sets`` does that).
    """
    exclude = set(exclude or [])
    body_cols = sorted(c for c in df.columns if c not in exclude)
    body = F.struct(*[F.col(f"`{c}`") for c in body_cols])
    return df.select(*key_cols, F.to_json(body, JSON_OPTS).alias(doc_col))


def parse_json_col(c: str | Column, schema: T.DataType | str) -> Column:
    """JSON text -> nested value with a declared schema."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, schema)


def dimension_from_json_array(df: DataFrame, body_col: str, element_schema: T.StructType | str,
                              select: dict[str, str]) -> DataFrame:
    """A list endpoint's body ``[{..}, {..}]`` -> one row per element.

    ``select`` maps element field -> output column name.  The array is split
    into rows with ``inline``, so each response row is processed by its own
    task and nothing is collected.  Bodies that are no JSON give no rows here;
    ``unparsed_bodies`` lists them.
    """
    if isinstance(element_schema, str):
        element_schema = T.StructType.fromDDL(element_schema)
    arr = F.from_json(F.col(body_col), T.ArrayType(element_schema))
    rows = df.select(F.inline(arr))
    return rows.select(*[F.col(k).alias(v) for k, v in select.items()])


def unparsed_bodies(df: DataFrame, body_col: str) -> DataFrame:
    """Rows whose body is not JSON (or holds a key twice): the quarantine of
    the readers in this module."""
    body = F.col(f"`{body_col}`")
    return df.where(body.isNotNull() & F.try_parse_json(body).isNull())


def _flatten_fields(dtype: T.DataType, path: list[str], kind: tuple, expr: Column, sizes: dict, sep: str):
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _flatten_fields(f.dataType, path + [f.name], kind + (f.name,), expr.getField(f.name), sizes, sep)
    elif isinstance(dtype, T.ArrayType):
        for i in range(sizes.get(kind, 0)):
            yield from _flatten_fields(dtype.elementType, path + [str(i)], kind + (None,), F.get(expr, i), sizes, sep)
    elif isinstance(dtype, T.MapType):
        raise ValueError(f"{sep.join(path)} is a map: its keys are data; use flatten_json_long")
    else:
        yield sep.join(path), expr


def _array_sizes(dtype: T.DataType, kind: tuple, over):
    """(array, largest size) for every array; ``over(f)`` is the largest of
    ``f`` over all values found at this place of a row."""
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _array_sizes(f.dataType, kind + (f.name,),
                                    lambda g, n=f.name: over(lambda v: g(v.getField(n))))
    elif isinstance(dtype, T.ArrayType):
        yield kind, over(F.size)
        yield from _array_sizes(dtype.elementType, kind + (None,),
                                lambda g: over(lambda v: F.array_max(F.transform(v, lambda e: g(e)))))


def flatten_json(df: DataFrame, col_name: str, keep: list[str] | None = None, sep: str = "_",
                 prefix: bool = False) -> DataFrame:
    """Flatten a struct column to ``a_b_0_c`` columns (S18), arrays inside
    arrays included.

    Arrays become one column per index up to the largest size seen anywhere;
    the sizes come from one aggregate (one number per array of the schema), not
    from collecting rows.  With ``prefix`` the column name is put in front of
    every path.  Names that clash are an error; ``flatten_json_long`` keeps
    both.
    """
    keep = keep or []
    dtype = df.schema[col_name].dataType
    base = [col_name] if prefix else []
    arrays = list(_array_sizes(dtype, tuple(base), lambda f: f(F.col(f"`{col_name}`"))))
    sizes = {}
    if arrays:
        row = df.agg(*[F.coalesce(F.max(size), F.lit(0)) for _, size in arrays]).first()
        sizes = {kind: max(int(row[i]), 0) for i, (kind, _) in enumerate(arrays)}
    fields = list(_flatten_fields(dtype, base, tuple(base), F.col(f"`{col_name}`"), sizes, sep))
    names = [n for n, _ in fields]
    clash = {n for n in names if names.count(n) > 1} | (set(names) & set(keep))
    if clash:
        raise ValueError(f"flattened names clash: {sorted(clash)}")
    return df.select(*keep, *[e.alias(n) for n, e in fields])


#: One JSON token: a text (escapes included), a bracket or comma, or a bare value.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},]|[^\s\[\]{},:"]+'
#: Leaves gathered at a time while a body is read.
_LEAF_CHUNK = 256


def json_leaves(body: str | Column, sep: str = "_") -> Column:
    """Leaves of a JSON text as ``array<struct<path, token>>``, null for a text
    that does not parse.

    One fold over the text's tokens: the state is the stack of open brackets
    with the name or position reached in each, so the expression is the same
    for every depth and shape, and a body is read once whatever it holds.
    Leaves are gathered in chunks, so a long body is not copied per leaf.
    """
    body = F.col(f"`{body}`") if isinstance(body, str) else body
    leaf = "struct<path:string,token:string>"

    def step(acc, t):
        kinds, at = acc["kinds"], acc["at"]
        in_object = kinds.endswith("{")
        opens, closes, comma = t.isin("{", "["), t.isin("}", "]"), t == ","
        names = in_object & acc["awaits"] & t.startswith('"')
        outer = F.slice(at, 1, F.size(at) - 1)
        name = F.when(t.contains("\\"), F.parse_json(t).cast("string")).otherwise(
            F.substring(t, F.lit(2), F.char_length(t) - 2))
        now_at = (F.when(opens, F.array_append(at, F.when(t == "[", "0").otherwise("")))
                  .when(closes, outer)
                  .when(comma & ~in_object, F.array_append(outer, (F.element_at(at, -1).cast("int") + 1).cast("string")))
                  .when(names, F.array_append(outer, name)).otherwise(at))
        empty = closes & acc["fresh"]
        found = F.when(empty, F.struct(F.array_join(outer, sep).alias("path"), F.concat(F.right(kinds, F.lit(1)), t).alias("token"))) \
            .when(~(opens | closes | comma | names), F.struct(F.array_join(at, sep).alias("path"), t.alias("token")))
        full = F.size(acc["now"]) >= _LEAF_CHUNK
        return F.struct(
            F.when(opens, F.concat(kinds, t)).when(closes, F.substring(kinds, F.lit(1), F.char_length(kinds) - 1))
            .otherwise(kinds).alias("kinds"),
            now_at.alias("at"), ((t == "{") | (comma & in_object)).alias("awaits"), opens.alias("fresh"),
            F.when(found.isNull(), acc["now"]).when(full, F.array(found)).otherwise(F.array_append(acc["now"], found)).alias("now"),
            F.when(found.isNotNull() & full, F.array_append(acc["done"], acc["now"])).otherwise(acc["done"]).alias("done"))

    start = F.struct(F.lit("").alias("kinds"), F.array().cast("array<string>").alias("at"), F.lit(False).alias("awaits"),
                     F.lit(False).alias("fresh"), F.array().cast(f"array<{leaf}>").alias("now"),
                     F.array().cast(f"array<array<{leaf}>>").alias("done"))
    whole = lambda acc: F.flatten(F.array_append(acc["done"], acc["now"]))
    return F.when(F.try_parse_json(body).isNotNull(),
                  F.aggregate(F.regexp_extract_all(body, F.lit(_TOKEN), F.lit(0)), start, step, whole))


def _leaf_text(token: Column) -> Column:
    """Text leaves without quotes and escapes, null for a JSON null."""
    return F.when(token.isin("{}", "[]"), token).otherwise(F.parse_json(token).cast("string"))


def flatten_json_long(df: DataFrame, key: str, body_col: str, sep: str = "_") -> DataFrame:
    """Flatten JSON text of any shape and depth to long form ``(key, path,
    value)`` (S18).

    One projection (see ``json_leaves``): nothing is read while the plan is
    built, and the plan is the same for every depth.  Types, not the look of a
    text, decide what is taken apart.  Paths join names and positions with
    ``sep`` (``a_b_0_c``).  Text leaves keep their text, other leaves are JSON
    text, a JSON null is null; an empty object or array is a leaf (``{}``,
    ``[]``).  Bodies that do not parse give no rows; see ``unparsed_bodies``.
    ``flatten_undeclared`` gives a wide table.
    """
    leaves = df.select(F.col(f"`{key}`").alias(key), F.explode(json_leaves(body_col, sep)).alias("leaf"))
    return leaves.select(key, F.col("leaf.path").alias("path"), _leaf_text(F.col("leaf.token")).alias("value"))


def answer_columns(df: DataFrame, body_col: str, sep: str = "_") -> dict[str, str]:
    """The one schema of all bodies of a column: flattened path -> type, by
    path (U3).

    One aggregate over the bodies' leaves brings one row per path to the
    driver.  A path that is always whole numbers is ``bigint``, numbers are
    ``double``, true / false is ``boolean``; anything else, mixed kinds
    included, is ``string``.
    """
    token = F.col("leaf.token")
    kind = (F.when(token == "null", F.lit(None)).when(token.isin("true", "false"), "boolean")
            .when(token.rlike(r"^-?\d{1,18}$"), "bigint").when(token.rlike(r"^-?\d"), "double").otherwise("string"))
    found = (df.select(F.explode(json_leaves(body_col, sep)).alias("leaf"))
             .groupBy(F.col("leaf.path").alias("path")).agg(F.collect_set(kind).alias("kinds")).collect())
    one = lambda kinds: kinds[0] if len(kinds) == 1 else "double" if set(kinds) == {"bigint", "double"} else "string"
    return {r["path"]: one(r["kinds"]) for r in sorted(found, key=lambda r: r["path"])}


def flatten_undeclared(df: DataFrame, body_col: str, keep: list[str] | None = None, sep: str = "_",
                       columns: dict[str, str] | None = None, prefix: str = "") -> DataFrame:
    """JSON text of undeclared shapes -> one wide row per row, a column for
    every path met in any body (S18, A13, U3).

    ``columns`` is the schema of ``answer_columns``; left out, it is taken from
    ``df`` itself, which reads the bodies one time more.  A body that lacks a
    path, or does not parse, has null there.  ``prefix`` goes in front of the
    path names; names that clash with ``keep`` are an error.
    """
    keep = keep or []
    columns = answer_columns(df, body_col, sep) if columns is None else columns
    clash = {prefix + p for p in columns} & set(keep)
    if clash:
        raise ValueError(f"flattened names clash: {sorted(clash)}; give a prefix")
    rows = df.select(*[F.col(f"`{c}`").alias(c) for c in keep], json_leaves(body_col, sep).alias("__leaves"))
    at = lambda p: _leaf_text(F.get(F.filter("__leaves", lambda x: x["path"] == F.lit(p)), F.lit(0))["token"])
    return rows.select(*[F.col(f"`{c}`") for c in keep],
                       *[at(p).cast(t).alias(prefix + p or "value") for p, t in columns.items()])
