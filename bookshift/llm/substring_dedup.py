"""Repeated passages by a compacted De Bruijn graph of token k-mers.

The graph's edges are the windows of ``WINDOW`` consecutive words; two windows
that follow each other in a text share a node.  A window is removed where its
words also start earlier, so only repeated edges matter, and those of a
passage that always occurs as a whole can be judged as one path.

1. One pass over the texts cuts each document into pieces: runs of windows
   that have the same minimiser (the ``GRAM``-word gram of least hash in a
   window).  Equal windows have equal minimisers, so a window can only repeat
   where its minimiser does.  A document is one row: the hashes of its pieces'
   minimisers and of their words.
2. An aggregate by minimiser finds the repeated ones, and tells of each
   whether it has one piece only (no branch within the piece), one following
   piece and one preceding piece.
3. Joined back to the documents, repeated pieces without a branch inside or
   between them compact to paths: all occurrences of a path have it whole, so
   it is one unit however long.  Windows of pieces with a branch stay units
   of their own.
4. A unit is named by a 128-bit digest of the words at its source coordinates
   (document and word range), read from the texts again; what the minimisers
   proposed counts only where these words agree.  The smallest ``doc_id`` of a
   unit is an aggregate; units of any later document, and those that started
   earlier in the same one, are removed.
5. Texts of documents that lose words are read once more for what is left.

Units that hold a large share of the rows are split into shares when they are
joined; nothing is collected but the pieces and ranges of one document.

Defined results: null, empty and blank texts have no words, and texts shorter
than a window lose none; a null ``doc_id`` is neither smaller nor larger than
another, so such a row only loses what it repeats itself; rows that share a
``doc_id`` are documents of their own, none smaller than the other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookshift.llm.common import broadcast_up_to, hot_keys, repeat_rows, small_batches, split_rows, stage, texts
from bookshift.llm.rolling import PIECE, range_hashes

WINDOW = 20
GRAM = 8
REPEATED, SIMPLE, ONE_NEXT, ONE_BEFORE = 1, 2, 4, 8
#: rows a task hands back at once
ROWS_OUT = 1 << 16

_KEY = "doc_id long, fp long"


def fingerprint(text: bytes) -> int:
    """64 bits that tell texts of one ``doc_id`` apart."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a single-spaced text."""
    if not data:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return np.append(0, gaps + 1), np.append(gaps, len(data))


def _hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of word ranges in order of their starts; long texts go in parts,
    so the working arrays stay small."""
    if len(data) <= 2 * PIECE:
        return range_hashes(data, starts, ends)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE)))
        a, z = int(starts[i]), int(ends[j - 1])
        out[i:j] = range_hashes(data[a:z], starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


def pieces(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, words, first, last) of the pieces of a text: hash of the
    minimiser, hash of all words of the piece, its first and last window."""
    n = len(starts) - WINDOW + 1
    if n < 1:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    grams = _hashes(data, starts[:len(starts) - GRAM + 1], ends[GRAM - 1:])
    at = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], n) - 1
    words = _hashes(data, starts[first], ends[last + WINDOW - 1])
    return grams[at[first]], np.maximum(words, np.uint64(1)), first, last


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps, counts, shas, mins, said = [], [], [], [], []
        for text in texts(b.column(1)):
            data = b" ".join(text.split())
            starts, ends = word_spans(data)
            m, w, _, _ = pieces(data, starts, ends)
            fps.append(fingerprint(text))
            counts.append(len(starts))
            shas.append(hashlib.sha256(data).hexdigest())
            mins.append(m.view(np.int64))
            said.append(w.view(np.int64))
        cuts = pa.array(np.cumsum([0, *map(len, mins)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([np.empty(0, np.int64), *x]))) for x in (mins, said)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(fps, pa.int64()), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), *lists],
            names=["doc_id", "fp", "n_words", "sha256", "grams", "said"])


def _units_of(data: bytes, flags: dict[int, int]) -> Iterator[tuple[bytes, int, int, bool]]:
    """(digest, first window, last window, stood earlier in this text) of the
    paths and single windows of the repeated pieces."""
    starts, ends = word_spans(data)
    _, _, first, last = pieces(data, starts, ends)
    seen = set()

    def unit(a: int, z: int):
        name = hashlib.blake2b(data[starts[a]:ends[z + WINDOW - 1]], digest_size=16).digest()
        again = name in seen
        seen.add(name)
        return name, a, z, again

    whole = SIMPLE | REPEATED
    i = 0
    while i < len(first):
        flag = flags.get(i, 0)
        j = i
        if flag & whole == whole:
            while (flags.get(j, 0) & ONE_NEXT and flags.get(j + 1, 0) & (whole | ONE_BEFORE) == whole | ONE_BEFORE):
                j += 1
            yield unit(int(first[i]), int(last[j]))
        elif flag:
            for s in range(int(first[i]), int(last[i]) + 1):
                yield unit(s, s)
        i = j + 1


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("unit", pa.binary()), ("doc_id", pa.int64()), ("fp", pa.int64()), ("first", pa.int32()),
                        ("last", pa.int32()), ("again", pa.bool_())])
    for b in batches:
        rows = []
        for doc_id, fp, text, marks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2)),
                                           b.column(3).to_pylist()):
            data = b" ".join(text.split())
            flags = {m >> 4: m & 15 for m in marks}
            rows += [(u, doc_id, fp, a, z, again) for u, a, z, again in _units_of(data, flags)]
            if len(rows) >= ROWS_OUT:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)


def covered(n: int, ranges: list[dict]) -> np.ndarray:
    """Which of ``n`` words lie in a window of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    for r in ranges:
        edge[r["first"]] += 1
        edge[r["last"] + WINDOW] -= 1
    return np.cumsum(edge[:-1]) > 0


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, gone, shas, kept_texts = [], [], [], []
        for text, ranges in zip(texts(b.column(1)), b.column(2).to_pylist()):
            words = text.split()
            cut = covered(len(words), ranges)
            kept = b" ".join([w for w, c in zip(words, cut.tolist()) if not c])
            counts.append(len(words))
            gone.append(int(cut.sum()))
            shas.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(shas, pa.string()),
             pa.array(kept_texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def _pairs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t) for t in texts(b.column(1))], pa.int64()),
                                          b.column(1)], names=["doc_id", "fp", "text"])


def _texts_of(docs: DataFrame, per_doc: DataFrame) -> DataFrame:
    """Texts of the documents in ``per_doc(doc_id, fp, ...)`` with its columns."""
    ids = broadcast_up_to(per_doc.select("doc_id"), per_doc.count(), 16)
    named = docs.alias("d").join(ids.alias("i"), F.expr("d.doc_id <=> i.doc_id"), "left_semi")
    keyed = named.mapInArrow(_keyed, f"{_KEY}, text string")
    rest = [c for c in per_doc.columns if c not in ("doc_id", "fp")]
    return (keyed.alias("t").join(per_doc.alias("p"), F.expr("t.fp = p.fp and t.doc_id <=> p.doc_id"))
            .select("t.doc_id", "t.fp", "t.text", *rest))


def repeated_units(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, units): one row per document (doc_id, fp, n_words, sha256)
    and one per occurrence of a unit (unit, doc_id, fp, first, last, again)."""
    pairs = _pairs(docs)
    small_batches(docs.sparkSession)
    read = stage(pairs.mapInArrow(_read, f"{_KEY}, n_words long, sha256 string, grams array<long>, said array<long>"), "pieces")
    place = F.transform("grams", lambda g, i: F.struct(
        g.alias("gram"), i.alias("i"), F.get("said", i).alias("words"),
        F.coalesce(F.get("said", i + 1), F.lit(0)).alias("next"), F.coalesce(F.get("said", i - 1), F.lit(0)).alias("before")))
    cut = read.select("doc_id", "fp", F.inline(place))
    one = lambda c: F.min(c) == F.max(c)
    graph = stage(cut.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), one("words").alias("simple"), one("next").alias("one_next"),
                                          one("before").alias("one_before")).filter("n > 1")
                  .select("gram", "n", (F.lit(REPEATED) + F.when(F.col("simple"), SIMPLE).otherwise(0)
                                        + F.when(F.col("one_next"), ONE_NEXT).otherwise(0)
                                        + F.when(F.col("one_before"), ONE_BEFORE).otherwise(0)).alias("flags")), "graph")
    total = read.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()[0]
    hot = hot_keys(graph, ["gram"], "n", total)
    found = split_rows(cut.select("doc_id", "fp", "gram", "i"), hot, ["gram"], ["doc_id", "fp"]).join(
        repeat_rows(graph.select("gram", "flags"), hot, ["gram"]), ["gram", "__share"])
    marks = stage(found.groupBy("doc_id", "fp").agg(F.collect_set((F.col("i") * 16 + F.col("flags")).cast("long")).alias("marks")),
                  "marks")
    units = stage(_texts_of(pairs, marks).mapInArrow(
        _units, f"unit binary, {_KEY}, first int, last int, again boolean"), "units")
    return read.select("doc_id", "fp", "n_words", "sha256"), units


def removed_ranges(units: DataFrame) -> DataFrame:
    """(doc_id, fp, ranges): the windows that also start earlier, by document."""
    first = stage(units.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
                  .filter("least < most"), "first")
    hot = hot_keys(first, ["unit"], "n", units.count())
    later = (split_rows(units, hot, ["unit"], ["doc_id", "fp"])
             .join(repeat_rows(first.select("unit", "least"), hot, ["unit"]), ["unit", "__share"], "left"))
    return (later.filter("again or least < doc_id").groupBy("doc_id", "fp")
            .agg(F.collect_set(F.struct("first", "last")).alias("ranges")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, and
    ``kept``, the words left, where any were removed."""
    rows, units = repeated_units(docs)
    ranges = stage(removed_ranges(units), "ranges")
    changed = _texts_of(_pairs(docs), ranges).select("doc_id", "text", "ranges").mapInArrow(
        _left, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    same = rows.alias("r").join(ranges.select("doc_id", "fp").alias("x"), F.expr("r.fp = x.fp and r.doc_id <=> x.doc_id"), "left_anti")
    return same.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha256").alias("kept_sha256"),
                       F.lit(None).cast("string").alias("kept")).unionByName(changed)
