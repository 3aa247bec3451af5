"""Exact duplicates by a Golomb-coded fingerprint exchange.

1. Every task hashes its documents (64 bits of the SHA-256 of the normalised
   text), sorts the distinct hashes and sends each hash owner one compressed
   row: the gaps between its hashes, Golomb-Rice coded, plus one bit a hash
   telling whether the task itself saw it twice.  Owners hold equal ranges of
   the hash space; their number is the session's shuffle partitions, so each
   owner's share stays the same as the input grows.
2. An owner decodes the lists it received and answers every sender with a
   bitmap over that sender's list: set where the hash occurs more than once.
   A text with very many copies costs an owner one entry a task.
3. Rows whose bit is set are suspects.  Only their texts are read again and
   shuffled, grouped by the text's bytes (partial sums first, so a task sends
   one copy of each text), which decides equality: texts that share the 64 bits
   stay apart, and two texts that shared a whole SHA-256 would stop the job.

Defined results: null text counts as empty and empty texts are equal to each
other; of rows that also share the largest ``doc_id`` exactly one is kept; a
null ``doc_id`` is smaller than any other; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookshift.llm.common import broadcast_up_to, hot_keys, lower_ascii, repeat_rows, small_batches, split_rows, stage, texts

#: rows a task hands back at once
ROWS_OUT = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FACTS = ("kind int, part long, owner int, idx int, row long, doc_id long, sha256 string, "
          "rice int, hashes int, gaps binary, repeated binary")


def normalise(text: bytes) -> bytes:
    """Lower-case A-Z only; all other bytes stay."""
    return text.translate(_LOWER)


def rice_encode(gaps: np.ndarray) -> tuple[int, bytes]:
    """Golomb-Rice code of non-negative gaps: quotient in unary, remainder in
    ``k`` bits, ``k`` chosen from the mean gap.  Returns (k, bytes)."""
    if not len(gaps):
        return 0, b""
    mean = float(gaps.astype(np.float64).mean())
    k = max(0, min(62, int(np.floor(np.log2(max(mean * 0.6931, 1.0))))))
    q = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(q + 1 + k)
    bits = np.ones(int(ends[-1]), np.uint8)
    stop = ends - k - 1
    bits[stop] = 0
    if k:
        shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
        rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        bits[(stop[:, None] + 1 + np.arange(k)).ravel()] = rest.ravel()
    return k, np.packbits(bits).tobytes()


def rice_decode(k: int, n: int, data: bytes) -> np.ndarray:
    """Inverse of :func:`rice_encode`; a loop over codes only finds their
    starts, remainders are read at once."""
    if not n:
        return np.empty(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    zeros = np.flatnonzero(bits == 0)
    stops = np.empty(n, np.int64)
    starts = np.empty(n, np.int64)
    at = z = 0
    find = zeros.searchsorted
    for i in range(n):
        z = int(find(at))
        starts[i] = at
        stops[i] = at = int(zeros[z])
        at += k + 1
    out = (stops - starts).astype(np.uint64) << np.uint64(k)
    if k:
        shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
        out |= (bits[stops[:, None] + 1 + np.arange(k)].astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)
    return out


def _fingerprints(owners: int):
    width = (1 << 64) // owners + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, digests = [], bytearray()
        for b in batches:
            ids.append(b.column(0).cast(pa.int64()))
            for t in texts(b.column(1)):
                digests += hashlib.sha256(normalise(t)).digest()
        n = len(digests) // 32
        if not n:
            return
        h = np.ascontiguousarray(np.frombuffer(digests, np.uint8).reshape(n, 32)[:, :8]).view(">u8")[:, 0].astype(np.uint64)
        uniq, place, times = np.unique(h, return_inverse=True, return_counts=True)
        owner_of = (uniq // np.uint64(width)).astype(np.int32)
        present, first = np.unique(owner_of, return_index=True)
        last = np.append(first[1:], len(uniq))
        start_of = np.zeros(owners, np.int64)
        start_of[present] = first
        owner, doc_ids = owner_of[place], pa.concat_arrays(ids)
        idx = (place - start_of[owner]).astype(np.int32)
        null = lambda kind, m: pa.nulls(m, kind)
        schema = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("owner", pa.int32()), ("idx", pa.int32()),
                            ("row", pa.int64()), ("doc_id", pa.int64()), ("sha256", pa.string()), ("rice", pa.int32()),
                            ("hashes", pa.int32()), ("gaps", pa.binary()), ("repeated", pa.binary())])
        full = lambda value, m, kind: pa.array(np.full(m, value), kind)
        for x in range(0, n, ROWS_OUT):
            y = min(n, x + ROWS_OUT)
            m = y - x
            yield pa.RecordBatch.from_arrays(
                [full(0, m, pa.int32()), full(part, m, pa.int64()), pa.array(owner[x:y], pa.int32()),
                 pa.array(idx[x:y]), pa.array(np.arange(x, y)), doc_ids[x:y],
                 pa.array([digests[32 * i:32 * i + 32].hex() for i in range(x, y)], pa.string()),
                 null(pa.int32(), m), null(pa.int32(), m), null(pa.binary(), m), null(pa.binary(), m)], schema=schema)
        lists = []
        for o, a, z in zip(present.tolist(), first.tolist(), last.tolist()):
            rest = uniq[a:z] - np.uint64(o * width)
            k, gaps = rice_encode(np.diff(rest, prepend=np.uint64(0)))
            lists.append((o, k, z - a, gaps, np.packbits(times[a:z] > 1).tobytes()))
        m = len(lists)
        yield pa.RecordBatch.from_arrays(
            [full(1, m, pa.int32()), full(part, m, pa.int64()), pa.array([x[0] for x in lists], pa.int32()),
             null(pa.int32(), m), null(pa.int64(), m), null(pa.int64(), m), null(pa.string(), m),
             pa.array([x[1] for x in lists], pa.int32()), pa.array([x[2] for x in lists], pa.int32()),
             pa.array([x[3] for x in lists], pa.binary()), pa.array([x[4] for x in lists], pa.binary())], schema=schema)

    return run


def _answer(pdf):
    """One owner: the lists of all senders in, a bitmap per sender out, as
    64-bit words (bit i of word w stands for entry 64 w + i)."""
    import pandas as pd

    lists = [np.cumsum(rice_decode(k, n, g), dtype=np.uint64) for k, n, g in zip(pdf.rice, pdf.hashes, pdf.gaps)]
    own = [np.unpackbits(np.frombuffer(r, np.uint8), count=n) > 0 for r, n in zip(pdf.repeated, pdf.hashes)]
    values = np.concatenate(lists)
    _, place, times = np.unique(values, return_inverse=True, return_counts=True)
    double = times[place] > 1
    out, at = [], 0
    for mine in own:
        bits = double[at:at + len(mine)] | mine
        at += len(mine)
        padded = np.zeros(-(-len(bits) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        out.append(np.packbits(padded, bitorder="little").view("<i8").tolist() if bits.any() else None)
    return pd.DataFrame({"part": pdf.part, "owner": pdf.owner, "bitmap": out}).dropna(subset=["bitmap"])


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per input row: doc_id, keep_id,
    group_size, kept, text_sha256."""
    spark = docs.sparkSession
    small_batches(spark)
    owners = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    facts = stage(pairs.mapInArrow(_fingerprints(owners), _FACTS), "fingerprints", partition_by="kind")
    rows = facts.filter("kind = 0").select("part", "owner", "idx", "row", "doc_id", "sha256")
    bitmaps = (facts.filter("kind = 1").select("part", "owner", "rice", "hashes", "gaps", "repeated")
               .groupBy("owner").applyInPandas(_answer, "part long, owner int, bitmap array<long>"))
    suspects = stage(rows.join(bitmaps, ["part", "owner"])
                     .filter(F.expr("(shiftright(element_at(bitmap, shiftright(idx, 6) + 1), idx & 63) & 1) = 1"))
                     .select("part", "row", "doc_id", "sha256"), "suspects")

    # byte verification: only texts of suspects move, one copy of each a task
    ids = broadcast_up_to(suspects.select(F.col("doc_id").alias("sid")), suspects.count(), 16)
    again = pairs.join(ids, F.col("doc_id").eqNullSafe(F.col("sid")), "left_semi")
    equal = (again.select("text").mapInArrow(_normalised, "sha256 string, text binary")
             .groupBy("sha256", "text").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("sha256").agg(F.count(F.lit(1)).alias("texts")))
    found = (suspects.groupBy("sha256")
             .agg(F.max(F.struct("doc_id", "part", "row")).alias("keep"), F.count(F.lit(1)).alias("size"))
             .filter("size > 1").join(equal, "sha256"))
    groups = stage(found.select(F.col("sha256").alias("g"), "size",
                                F.when(F.col("texts") == 1, F.col("keep")).otherwise(
                                    F.raise_error(F.lit("different texts share a SHA-256"))).alias("keep")), "copies")
    alone = F.col("keep").isNull()
    # a text that holds a large share of the rows is split over tasks
    hot = hot_keys(groups, ["g"], "size", rows.count())
    dealt = split_rows(rows.withColumn("g", F.col("sha256")), hot, ["g"], ["part", "row"])
    return (dealt.join(repeat_rows(groups, hot, ["g"]), ["g", "__share"], "left")
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
                    F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                    (alone | (F.struct("part", "row") == F.struct("keep.part", "keep.row"))).alias("kept"),
                    F.col("sha256").alias("text_sha256")))


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        plain = [normalise(t) for t in texts(b.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(t).hexdigest() for t in plain], pa.string()),
                                          pa.array(plain, pa.binary())], names=["sha256", "text"])


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`duplicate_groups` drops, all
    columns kept.  Rows are told apart by ``doc_id``; only where a ``doc_id``
    repeats are its rows compared by text as well."""
    judged = stage(duplicate_groups(docs), "groups")
    by_id = judged.groupBy("doc_id").agg(F.max("kept").alias("any_kept"), F.count(F.lit(1)).alias("n"))
    special = stage(by_id.filter("n > 1 or not any_kept").select(F.col("doc_id").alias("sid"), "n"), "dropped")
    single = docs.join(special, docs["doc_id"].eqNullSafe(special["sid"]), "left_anti")
    repeated = special.filter("n > 1")
    if not repeated.head(1):
        return single
    kept = judged.filter("kept").select(F.col("doc_id").alias("kid"), "text_sha256")
    twice = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated["sid"]), "left_semi")
    sha = F.sha2(lower_ascii(F.coalesce(docs["text"], F.lit(""))), 256)
    same = docs["doc_id"].eqNullSafe(kept["kid"]) & (F.col("__sha") == kept["text_sha256"])
    return single.unionByName(
        twice.withColumn("__sha", sha).join(kept, same, "left_semi").dropDuplicates(["doc_id", "__sha"]).drop("__sha"))
