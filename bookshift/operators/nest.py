"""Nest staged rows into one document row per entity.

A *field set* names a group of columns that becomes one attribute of the
document: an object (the entity's first record) or an array of objects (all
records, in staged order).  All field sets of a document are built by ONE
``groupBy(keys).agg(...)``: no per-field-set aggregate and no re-join of the
pieces.  ``min_by`` and ``count`` shrink in the
map tasks; ``collect_list`` moves every record's bytes once, because the
document holds them all.  ``document_headers`` and ``document_elements`` give
the same content uncollected, for entities no row should hold.

Rules kept from the original pipeline (see the P-numbers in the README):

* P2  rows whose group key is null are dropped (``null_keys="drop"``);
      ``quarantine_null_keys`` returns them.  ``null_keys="keep"`` keeps them.
* P3  object field set = the record with the lowest staged order, as a whole.
* P4  array field set = every record in staged order, duplicates included.
* P5  object pruning: an object whose fields are all null becomes null.
* P6  array pruning: an element whose fields are all null (or the text
      ``"nan"``) becomes null; an array that is exactly ``[null]`` becomes null.
* P7  the ``"nan"`` test is for array elements only.
* P8  the original emitted one identical document per staged row.  Here the
      document carries ``copies`` (staged rows per entity) instead of being
      repeated; ``expand_copies`` gives the repeated form when it is wanted.
      Repeating an n-element document n times is quadratic in the entity
      size, which a large entity cannot afford.
* P9  field names are sorted at every level, so ``to_json`` text has sorted keys.

Staged order is an explicit list of columns (``order_by``), compared as a
struct; it must be total for results to be deterministic.  No window over the
entity is needed.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookshift.operators.rows import range_cuts, range_of


@dataclass(frozen=True)
class FieldSet:
    """One document attribute built from ``fields``; ``array`` -> list of objects."""
    name: str
    fields: tuple[str, ...]
    array: bool = False
    prune: bool = True

    def __init__(self, name: str, fields: Sequence[str], array: bool = False, prune: bool = True):
        object.__setattr__(self, "name", name)
        object.__setattr__(self, "fields", tuple(fields))
        object.__setattr__(self, "array", array)
        object.__setattr__(self, "prune", prune)


def _order_struct(order_by: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])


def _all_null(x: Column, fields: Sequence[str], nan_text: bool, types: dict) -> Column:
    conds = []
    for f in fields:
        v = x.getField(f)
        if nan_text and isinstance(types[f], T.StringType):
            conds.append(v.isNull() | (v == F.lit("nan")))
        else:
            conds.append(v.isNull())
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _prune_object(x: Column, fs: FieldSet, types: dict) -> Column:
    """P5: an object whose fields are all null becomes null."""
    if not fs.prune:
        return x
    return F.when(_all_null(x, fs.fields, False, types), F.lit(None)).otherwise(x)


def _prune_array(elems: Column, fs: FieldSet, types: dict) -> Column:
    """All-null (or ``"nan"``) elements become null; exactly ``[null]`` becomes null."""
    if not fs.prune:
        return elems
    pruned = F.transform(elems, lambda e: F.when(_all_null(e, fs.fields, True, types), F.lit(None))
                         .otherwise(e))
    return F.when((F.size(pruned) == 1) & pruned.getItem(0).isNull(), F.lit(None)).otherwise(pruned)


def _project(rec: Column, fields: Sequence[str], constants: Mapping[str, Column] | None = None) -> Column:
    constants = constants or {}
    return F.struct(*[(constants[f] if f in constants else rec.getField(f)).alias(f) for f in sorted(fields)])


def _projector(fields: Sequence[str], constants: Mapping[str, Column] | None = None):
    """One-argument lambda for ``transform`` (a second argument would be the index)."""
    return lambda x: _project(x, fields, constants)


def _constant_types(df: DataFrame, constants: Mapping[str, Column]) -> dict:
    """Data types of constant columns, read from a one-row projection's schema (no job)."""
    if not constants:
        return {}
    return {f.name: f.dataType for f in df.select(*[c.alias(n) for n, c in constants.items()]).schema.fields}


def nest_field_sets(df: DataFrame, keys: Sequence[str], field_sets: Sequence[FieldSet],
                    order_by: Sequence[str | Column], null_keys: str = "drop",
                    copies_col: str | None = "copies",
                    constants: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per distinct key tuple: keys + one column per field set (+ copies).

    Output columns are the keys in the given order, then the field sets in
    name order, then ``copies``.

    Plan: when any field set is an array, every record of the entity is
    needed anyway, so ONE ``collect_list`` of ``(order, all fields)`` is
    built (an object hash aggregate with a partial phase), sorted once, and
    each object field set takes the first record while each array field set
    projects all of them.  With objects only, ONE ``min_by`` over the
    combined record keeps just the first record per entity.  Either way the
    entity is shuffled once and no field set is joined back.

    ``constants`` maps field or key names to literal Columns (product
    defaults): they are not carried through the shuffle or the collected
    records but attached after the aggregation, in the same sorted place.
    A constant key does not take part in the grouping.
    """
    if null_keys not in ("drop", "keep"):
        raise ValueError("null_keys must be 'drop' or 'keep'")
    constants = dict(constants or {})
    var_keys = [k for k in keys if k not in constants]
    staged = df.where(_keys_not_null(var_keys)) if null_keys == "drop" and var_keys else df
    types = {f.name: f.dataType for f in staged.schema.fields}
    types.update(_constant_types(staged, constants))
    order = _order_struct(order_by)
    fields = sorted({f for fs in field_sets for f in fs.fields} - set(constants))
    record = F.struct(*([F.col(f"`{f}`").alias(f) for f in fields] or [F.lit(True).alias("__none")]))
    group_cols = [F.col(f"`{k}`") for k in var_keys]
    sets = sorted(field_sets, key=lambda f: f.name)
    has_array = any(fs.array for fs in sets)

    if has_array:
        grouped = staged.groupBy(*group_cols).agg(
            F.collect_list(F.struct(order.alias("o"), record.alias("r"))).alias("__recs"))
        # sort_array has one ordering for all records; array_sort makes one for each two it compares
        grouped = grouped.select(*[F.col(f"`{k}`") for k in var_keys],
                                 F.transform(F.sort_array("__recs"), lambda x: x.getField("r")).alias("__recs"))
        first = F.col("__recs").getItem(0)
        copies = F.size("__recs").cast("bigint")
    else:
        grouped = staged.groupBy(*group_cols).agg(F.min_by(record, order).alias("__first"),
                                                  F.count(F.lit(1)).alias("__n"))
        first = F.col("__first")
        copies = F.col("__n")

    outs = []
    for fs in sets:
        if fs.array:
            elems = F.transform(F.col("__recs"), _projector(fs.fields, constants))
            outs.append(_prune_array(elems, fs, types).alias(fs.name))
        else:
            outs.append(_prune_object(_project(first, fs.fields, constants), fs, types).alias(fs.name))
    if copies_col:
        outs.append(copies.alias(copies_col))
    key_cols = [(constants[k] if k in constants else F.col(f"`{k}`")).alias(k) for k in keys]
    return grouped.select(*key_cols, *outs)


def nest_object(df: DataFrame, keys: Sequence[str], name: str, fields: Sequence[str],
                order_by: Sequence[str | Column], null_keys: str = "drop") -> DataFrame:
    """One object per key (first record in staged order, pruned)."""
    return nest_field_sets(df, keys, [FieldSet(name, fields, False)], order_by, null_keys, None)


def nest_array(df: DataFrame, keys: Sequence[str], name: str, fields: Sequence[str],
               order_by: Sequence[str | Column], null_keys: str = "drop", prune: bool = True) -> DataFrame:
    """Array of objects per key (every record in staged order, pruned)."""
    return nest_field_sets(df, keys, [FieldSet(name, fields, True, prune)], order_by, null_keys, None)


def expand_copies(df: DataFrame, copies_col: str = "copies") -> DataFrame:
    """Repeat each document ``copies`` times (the original's P8 output shape)."""
    return (df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(copies_col))))
            .drop("_copy"))


def _keys_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"`{k}`").isNotNull()
    return cond


def quarantine_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1: the staged rows a ``null_keys="drop"`` nest leaves out, with the
    names of their null keys."""
    null_names = F.array_compact(F.array(*[F.when(F.col(f"`{k}`").isNull(), F.lit(k)) for k in keys]))
    return df.where(~_keys_not_null(keys)).withColumn("null_keys", F.array_join(null_names, ","))


def duplicate_entities(df: DataFrame, keys: Sequence[str], min_rows: int = 2) -> DataFrame:
    """Q4: entities with more than one staged row (each would be repeated)."""
    return (df.where(_keys_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("staged_rows"))
            .where(F.col("staged_rows") >= min_rows))


def document_headers(df: DataFrame, keys: Sequence[str], field_sets: Sequence[FieldSet],
                     order_by: Sequence[str | Column], null_keys: str = "drop", copies_col: str = "copies",
                     constants: Mapping[str, Column] | None = None) -> DataFrame:
    """Every entity without its arrays: keys, object field sets (first record,
    partial ``min_by``) and ``copies``.  With ``document_elements`` this is the
    uncollected form of ``nest_field_sets``, for entities of any size: no task
    ever holds the records of an entity together."""
    objects = [fs for fs in field_sets if not fs.array]
    return nest_field_sets(df, keys, objects, order_by, null_keys, copies_col, constants)


def document_elements(df: DataFrame, keys: Sequence[str], field_sets: Sequence[FieldSet],
                      order_by: Sequence[str | Column], null_keys: str = "drop",
                      constants: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per array element of every entity: ``(keys..., field_set,
    order, element)``, ``element`` as JSON text (``null`` for a pruned one) and
    ``order`` the staged-order struct.  A projection; nothing is shuffled."""
    constants = dict(constants or {})
    var_keys = [k for k in keys if k not in constants]
    staged = df.where(_keys_not_null(var_keys)) if null_keys == "drop" and var_keys else df
    types = {f.name: f.dataType for f in staged.schema.fields} | _constant_types(staged, constants)
    value = lambda c: constants[c] if c in constants else F.col(f"`{c}`")
    made = []
    for fs in (f for f in field_sets if f.array):
        elem = F.struct(*[value(f).alias(f) for f in sorted(fs.fields)])
        if fs.prune:
            elem = F.when(_all_null(elem, fs.fields, True, types), F.lit(None)).otherwise(elem)
        made.append(F.struct(F.lit(fs.name).alias("field_set"), _order_struct(order_by).alias("order"),
                             F.coalesce(F.to_json(elem), F.lit("null")).alias("element")))
    if not made:
        raise ValueError("no field set is an array")
    return staged.select(*[value(k).alias(k) for k in keys], F.inline(F.array(*made)))


def document_chunks(df: DataFrame, keys: Sequence[str], field_sets: Sequence[FieldSet],
                    order_by: Sequence[str | Column], budget: int, null_keys: str = "drop",
                    constants: Mapping[str, Column] | None = None, ranges: int | None = None) -> DataFrame:
    """The arrays of every entity as JSON text in numbered continuation rows of
    about ``budget`` bytes: ``(keys..., field_set, chunk, n_elements, text)``.

    The texts of an entity's chunks, in order, concatenate to the JSON of the
    array that ``nest_field_sets`` builds (a pruned ``[null]`` has no chunk).
    A row holds the elements that begin within its ``budget`` bytes, so an
    entity of any size is never in one row.  The bytes before an element are a
    prefix sum in two steps: within ranges cut by keys, field set and order
    (an entity is cut wherever it is large), then over the ranges of an entity.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    elements = document_elements(df, keys, field_sets, order_by, null_keys, constants)
    orders = [f.name for f in elements.schema["order"].dataType.fields]
    flat = elements.select(*[F.col(f"`{k}`") for k in keys], "field_set", *[F.col(f"order.{o}").alias(f"__{o}") for o in orders], "element")
    by = [*keys, "field_set", *[f"__{o}" for o in orders]]
    ranged = (flat.withColumn("__range", range_of(by, range_cuts(flat, by, n)))
              .withColumn("__bytes", F.octet_length("element") + 1))
    entity = [*keys, "field_set"]
    per = ranged.groupBy("__range", *entity).agg(F.sum("__bytes").alias("__b"), F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(*entity).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("__range", *entity, F.coalesce(F.sum("__b").over(ahead), F.lit(0)).alias("__b0"),
                     F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__n0"),
                     F.sum("__n").over(Window.partitionBy(*entity)).alias("__all"))  # a row for each range of an entity
    inner = Window.partitionBy("__range", *entity).orderBy(*[f"__{o}" for o in orders])
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("__b1", F.coalesce(F.sum("__bytes").over(before), F.lit(0))).withColumn(
        "__n1", F.row_number().over(inner))
    same = F.col("x.__range") == F.col("y.__range")
    for c in entity:
        same = same & F.col(f"x.`{c}`").eqNullSafe(F.col(f"y.`{c}`"))
    met = placed.alias("x").join(per.alias("y"), same).select(
        "x.*", F.floor((F.col("__b0") + F.col("__b1")) / budget).cast("int").alias("chunk"),
        (F.col("__n0") + F.col("__n1") == 1).alias("first"), (F.col("__n0") + F.col("__n1") == F.col("__all")).alias("last"))
    pruned = [fs.name for fs in field_sets if fs.array and fs.prune]
    alone = F.col("first") & F.col("last") & (F.col("element") == "null") & F.col("field_set").isin(pruned)
    texts = met.where(~alone).groupBy(*entity, "chunk").agg(
        F.array_sort(F.collect_list(F.struct(*[f"__{o}" for o in orders], "element"))).alias("es"),
        F.max("first").alias("first"), F.max("last").alias("last"))
    joined = F.array_join(F.transform("es", lambda e: e["element"]), ",")
    return texts.select(*[F.col(f"`{c}`") for c in entity], "chunk", F.size("es").cast("long").alias("n_elements"),
                        F.concat(F.when(F.col("first"), "[").otherwise(","), joined, F.when(F.col("last"), "]").otherwise("")).alias("text"))


class QualityCounts:
    """Counts that ride along with the write of nested documents (Q1, Q4): what
    ``quality_report`` says, from the same execution.  ``counts()`` waits for
    the first action on the documents."""

    def __init__(self, name: str = "nest"):
        self.staged = Observation(f"{name}-staged-{uuid.uuid4().hex}")
        self.nested = Observation(f"{name}-nested-{uuid.uuid4().hex}")

    def counts(self) -> dict[str, int | None]:
        return {**self.staged.get, **self.nested.get}


def nest_counted(df: DataFrame, keys: Sequence[str], field_sets: Sequence[FieldSet], order_by: Sequence[str | Column],
                 name: str = "nest", **options) -> tuple[DataFrame, QualityCounts]:
    """``nest_field_sets`` (null keys dropped), and its quality counts: staged
    rows, rows dropped for a null key, entities, entities with several rows and
    the rows of the largest.  The sources are read once, by the action that
    writes the documents."""
    said = QualityCounts(name)
    staged = df.observe(said.staged, F.count(F.lit(1)).alias("staged_rows"),
                        F.count_if(~_keys_not_null([k for k in keys if k in df.columns])).alias("null_key_rows"))
    nested = nest_field_sets(staged, keys, field_sets, order_by, null_keys="drop", copies_col="copies", **options)
    return nested.observe(said.nested, F.count(F.lit(1)).alias("entities"), F.count_if(F.col("copies") > 1).alias("entities_with_copies"),
                          F.max("copies").alias("largest_entity_rows")), said


def quality_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row describing what nesting ``df`` by ``keys`` will do (Q1, Q4).

    ``staged_rows``, ``null_key_rows`` (dropped by P2), ``entities``,
    ``entities_with_copies`` (more than one staged row, P8) and
    ``largest_entity_rows``.  One partial aggregate per key, then one global
    aggregate over the per-key counts; no join.
    """
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    per_key = per_key.withColumn("is_null", ~_keys_not_null(keys))
    real = ~F.col("is_null")
    return per_key.agg(
        F.sum("n").cast("bigint").alias("staged_rows"),
        F.coalesce(F.sum(F.when(F.col("is_null"), F.col("n"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
        F.count(F.when(real, 1)).cast("bigint").alias("entities"),
        F.count(F.when(real & (F.col("n") > 1), 1)).cast("bigint").alias("entities_with_copies"),
        F.max(F.when(real, F.col("n"))).cast("bigint").alias("largest_entity_rows"))
