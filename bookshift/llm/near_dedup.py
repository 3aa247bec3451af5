"""MinHash near-duplicates from bottom-k sketches of one hash function.

1. One pass over the texts gives each document the size of its set of 5-word
   shingles, a 128-bit fingerprint of the set and its bottom-k sketch (the k
   smallest shingle hashes; the whole set where that is smaller).
2. Documents of equal sets form a class; from here on a class is one row with
   a number of its own, so documents that share a ``doc_id`` are never mixed.
3. Inverted lists over retained values generate the candidates.  Two sets of
   similarity 0.85 share about 0.85 k of the values in their union's sketch;
   fewer than half of 64 happens once in 10^11 pairs.  Both must then meet in
   one of their ``k - k/2 + 1`` rarest retained values (any two sets of k that
   share k/2 do), so only those lists are built, and values that nearly every
   document holds (shared passages, common lines) never list anything unless
   a sketch is made of little else.  Classes that meet in a list directly or
   through others form a candidate group.
4. The members of a group are compared in blocks of bounded size, every block
   with every other: the sketches of a pair estimate its similarity first, and
   pairs that may reach the threshold are confirmed on the full sets, read
   from the texts again.  Within a block a member joins a component by one
   confirmed link, so what a block returns is at most one row a member; no
   list of pairs is ever made.
5. Connected components over the confirmed links.

The least similarity is a parameter, 85 in a hundred unless given; what two
sketches must share follows from it.

Defined results: null, empty and word-free texts have no shingles and link
with nothing; rows with a null ``doc_id`` link with nothing either and have a
null component; rows that share a ``doc_id`` are judged one by one, each by
its own text; an empty table gives no rows; other columns are ignored.
:func:`drop_near_duplicates` drops rows, not ids: of a component the row with
the smallest ``doc_id`` stays, of several such rows the one with the least
text fingerprint, of equal rows one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from bookshift.llm.common import broadcast_up_to, hot_keys, repeat_rows, small_batches, split_rows, stage, texts
from bookshift.llm.graph import components
from bookshift.llm.rolling import shingles

SKETCH = 64
PERCENT = 85
#: Two sets at the threshold share fewer than so many of a hundred values of
#: their union's sketch less often than once in 10^9 pairs (binomial tail).
SHARED = {80: 45, 85: 50, 90: 60, 95: 70}
#: Bytes of shingle hashes in one block of a candidate group.
BLOCK_BYTES = 1 << 21


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, prints, kept, said = [], [], [], []
        for text in texts(b.column(1)):
            s = shingles(text)
            sizes.append(len(s))
            prints.append(set_print(s))
            said.append(text_print(text))
            kept.append(s[:SKETCH].view(np.int64))
        ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
        values = np.concatenate([np.empty(0, np.int64), *kept])
        yield pa.RecordBatch.from_arrays(
            [b.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), pa.array(said, pa.int64())],
            names=["doc_id", "n", "fp", "sketch", "said"])


def set_print(s: np.ndarray) -> bytes:
    """128 bits that stand for a set of shingles."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def text_print(text: bytes) -> int:
    """64 bits that tell the texts of one ``doc_id`` apart."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the texts that are of the class they were read for (another
    text may have the same ``doc_id``)."""
    for b in batches:
        sets = [shingles(t) for t in texts(b.column(0))]
        own = pa.array([set_print(s) == fp for s, fp in zip(sets, b.column(1).to_pylist())], pa.bool_())
        made = pa.RecordBatch.from_arrays([b.column(2), b.column(3), b.column(4), pa.array([s.tobytes() for s in sets], pa.binary())],
                                          names=["cid", "grp", "blocks", "shingles"])
        yield made.filter(own)


def _may_link(sketch: np.ndarray, others: np.ndarray, floor: float) -> np.ndarray:
    """Whether the union-sketch estimate of each other sketch is at least
    ``floor``.  Sketches are sorted and padded with the largest hash."""
    both = np.sort(np.concatenate([np.broadcast_to(sketch, others.shape), others], axis=1), axis=1)
    again = both[:, 1:] == both[:, :-1]
    first = np.concatenate([np.ones((len(both), 1), bool), ~again], axis=1)
    pad = np.uint64(2**64 - 1)
    rank = np.cumsum(first & (both != pad), axis=1)
    k = np.minimum(SKETCH, rank[:, -1])
    shared = (again & (both[:, 1:] != pad) & (rank[:, 1:] <= k[:, None])).sum(axis=1)
    return shared >= floor * k


def _links(reps: np.ndarray, blobs: list[bytes], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Spanning forest of the links among one block or pair of blocks."""
    floor = _shared(percent) / 100
    sets = [np.frombuffer(x, np.uint64) for x in blobs]
    size = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    width = int(code.max()) + 1
    ends = np.cumsum(size)
    own = [code[a:z] for a, z in zip(ends - size, ends)]
    sketch = np.full((len(sets), SKETCH), 2**64 - 1, np.uint64)
    for i, s in enumerate(sets):
        sketch[i, :min(len(s), SKETCH)] = s[:SKETCH]
    left = np.arange(len(sets))
    queue: list[int] = []
    out = []
    mark = np.zeros(width, bool)
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
        x = queue.pop()
        near = left[(100 * np.minimum(size[left], size[x]) >= percent * np.maximum(size[left], size[x]))]
        if len(near) > 1:
            near = near[_may_link(sketch[x], sketch[near], floor)]
        if not len(near):
            continue
        mark[own[x]] = True
        both = np.add.reduceat(mark[np.concatenate([own[i] for i in near])].astype(np.int64),
                               np.append(0, np.cumsum(size[near])[:-1]))
        mark[own[x]] = False
        linked = near[100 * both >= percent * (size[near] + size[x] - both)]
        out += [(int(reps[x]), int(reps[i])) for i in linked]
        queue += linked.tolist()
        left = np.setdiff1d(left, linked, assume_unique=True)
    return out


def _shared(percent: int) -> int:
    return SHARED[max(p for p in SHARED if p <= percent)]


def _confirm(percent: int):
    def run(group: pa.Table) -> pa.Table:
        found = _links(group.column("cid").to_numpy(), group.column("shingles").to_pylist(), percent)
        return pa.table({"u": pa.array([a for a, _ in found], pa.int64()), "v": pa.array([z for _, z in found], pa.int64())})
    return run


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, said, component, label): one row per input row.  ``label`` tells
    components apart that have the same smallest ``doc_id``."""
    if not min(SHARED) <= percent <= 100:
        raise ValueError(f"the least similarity is {min(SHARED)} to 100 in a hundred")
    spark = docs.sparkSession
    small_batches(spark)
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(pairs.mapInArrow(_sketches, "doc_id long, n long, fp binary, sketch array<long>, said long"), "sketches")
    classes = stage(rows.filter("n > 0 and doc_id is not null").groupBy("fp", "n", "sketch")
                    .agg(F.min("doc_id").alias("rep")).withColumn("cid", F.monotonically_increasing_id()), "classes")

    values = classes.select("cid", "n", F.explode("sketch").alias("value"))
    shared = values.join(values.groupBy("value").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "value")
    kept = F.least(F.col("n"), F.lit(SKETCH))
    least = SKETCH * _shared(percent) // 100
    must = F.when(F.col("n") < SKETCH, F.least(F.ceil(F.col("n") * percent / 100), F.lit(least))).otherwise(least)
    own = W.partitionBy("cid")
    # retained values that no other class holds come first in rarity and list nothing
    prefix = stage(shared.withColumn("place", F.row_number().over(own.orderBy("held", "value")))
                   .withColumn("alone", kept - F.count(F.lit(1)).over(own))
                   .filter(F.col("place") + F.col("alone") <= kept - must + 1).select("value", "cid"), "lists")
    heads = prefix.groupBy("value").agg(F.min("cid").alias("head"), F.max("cid").alias("last")).filter("head < last")
    meet = prefix.join(heads, "value").filter("cid <> head").select(F.col("cid").alias("u"), F.col("head").alias("v"))
    groups = components(meet.distinct()).select(F.col("node").alias("cid"), F.col("label").alias("grp"))

    sized = groups.join(classes.select("cid", "n", "fp", "rep"), "cid")
    per = sized.groupBy("grp").agg(F.ceil(F.sum("n") * 8 / BLOCK_BYTES).cast("int").alias("blocks"))
    todo = stage(sized.join(per, "grp").select("rep", "fp", "cid", "grp", "blocks"), "members")
    todo = broadcast_up_to(todo, todo.count(), 64)
    sets = (pairs.join(todo, F.col("doc_id") == F.col("rep")).select("text", "fp", "cid", "grp", "blocks")
            .mapInArrow(_members, "cid long, grp long, blocks int, shingles binary")
            .dropDuplicates(["cid"]))  # rows may stand more than once
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (sets.withColumn("block", block).select("*", other)
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
    links = stage(dealt.select("grp", "i", "j", "cid", "shingles").groupBy("grp", "i", "j")
                  .applyInArrow(_confirm(percent), "u long, v long"), "links")
    named = components(links).join(classes.select("cid", "fp", "rep"), F.col("cid") == F.col("node"))
    least_id = named.groupBy("label").agg(F.min("rep").alias("component"))
    ids = named.join(least_id, "label").select(F.col("fp").alias("cfp"), "component", "label").unionByName(
        classes.join(named.select("cid"), "cid", "left_anti").select(
            F.col("fp").alias("cfp"), F.col("rep").alias("component"), F.col("cid").alias("label")))
    ids = stage(ids, "components")
    held = stage(rows.filter("n > 0").groupBy(F.col("fp").alias("cfp")).agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "held")
    hot = hot_keys(held, ["cfp"], "held", rows.count())
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component")
    marked = split_rows(rows.filter("n > 0").select("doc_id", "n", F.col("fp").alias("cfp"), "said"), hot, ["cfp"], ["doc_id", "said"])
    linked = marked.join(repeat_rows(ids, hot, ["cfp"]), ["cfp", "__share"], "left").select("doc_id", "n", "said", component, "label")
    return linked.unionByName(rows.filter("n = 0").select("doc_id", "n", "said", F.col("doc_id").alias("component"),
                                                          F.lit(None).cast("long").alias("label")))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per input row: doc_id, n_shingles,
    component_id, kept.  ``percent`` is the least similarity of a link."""
    return _judged(docs, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([text_print(t) for t in texts(b.column(b.schema.get_field_index("__text")))],
                                                               pa.int64())], names=[*b.schema.names, "__said"])


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without near copies, all columns kept: one row of each component
    stays.  Rows without shingles and rows with a null ``doc_id`` all stay."""
    judged = stage(_judged(docs, percent), "near")
    # of a component's rows one stays: least doc_id, then least text fingerprint
    real = judged.filter("n > 0 and doc_id is not null")
    heads = real.groupBy("label").agg(F.min(F.struct("doc_id", "said")).alias("head"), F.count(F.lit(1)).alias("held"))
    heads = stage(heads.filter("held > 1"), "heads")
    hot = hot_keys(heads, ["label"], "held", judged.count())
    met = split_rows(real, hot, ["label"], ["doc_id", "said"]).join(
        repeat_rows(heads.select("label", "head"), hot, ["label"]), ["label", "__share"])
    told = met.withColumn("stays", F.expr("struct(doc_id, said) = head")).groupBy("doc_id", "said").agg(
        F.max("stays").alias("__stays"), F.count(F.lit(1)).alias("__rows")).filter("not __stays or __rows > 1")
    verdicts = stage(told.select(F.col("doc_id").alias("__id"), F.col("said").alias("__print"), "__stays"), "dropped")
    # only rows whose id is named in a verdict are looked at by text
    listed = broadcast_up_to(verdicts.select("__id").distinct(), verdicts.count(), 16)
    schema = T.StructType([*docs.schema.fields, T.StructField("__text", T.StringType()), T.StructField("__said", T.LongType())])
    named = (docs.join(listed, docs["doc_id"] == listed["__id"], "left_semi").withColumn("__text", F.col("text").cast("string"))
             .mapInArrow(_told, schema))
    met = named.join(verdicts, (named["doc_id"] == verdicts["__id"]) & (named["__said"] == verdicts["__print"]), "left")
    once = met.filter("__stays").dropDuplicates(["__id", "__print"])
    return (docs.join(listed, docs["doc_id"] == listed["__id"], "left_anti")
            .unionByName(met.filter("__stays is null").select(*docs.columns)).unionByName(once.select(*docs.columns)))
