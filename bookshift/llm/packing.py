"""Best-fit packing by a configuration linear program over the length histogram.

1. One pass tokenizes every document; only documents longer than a sequence
   are cut.  Pieces carry their number among the pieces of their length in
   their task, so a piece is known by (length, rank) without any sort.
2. The histogram of lengths (at most ``capacity`` numbers, whatever the size
   of the corpus) defines the configuration LP: cover each length's pieces
   with as few sequences as possible, a configuration being a multiset of
   lengths that fits a sequence.  Multiplicative weights solve it: a
   price starts as the length and falls by a factor as the length is covered; a
   bounded-knapsack dynamic program finds the configuration worth most at these
   prices among ``PRICED`` lengths drawn by what is left of them; it is taken for
   a share of its scarcest length.  The rounds go on until the covering
   constraints hold but for ``TOLERANCE`` of the tokens.  Each round takes at
   least that share of some length, so there are at most (lengths / ``STEP``)
   rounds whatever the counts.  Prices over all lengths also give the bound that
   no packing can beat (``lower_bound``).
3. Steps of more than one sequence are rounded down to whole ones; what is left
   goes best-fit into open sequences, by groups of equal ones.
4. The plan says which ranks of a length go to which sequences and offsets;
   every task places its own pieces by binary search.

Only per-length counts reach the driver; the plan's size depends on the
capacity, not on the corpus.

Defined results: a null or empty text is the end token alone; every input row
counts as a document, also where ``doc_id`` repeats or is null; an empty
table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import functools
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from bookshift.llm.common import small_batches, stage, texts

CAPACITY = 2048
END_ID = 0
#: share of its scarcest length that a configuration is taken for, rate at which
#: prices fall, share of the tokens that may stay uncovered, lengths priced at once
STEP = 0.5
RATE = 0.05
TOLERANCE = 0.02
PRICED = 96


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=1)
def _encoder(path: str):
    """The byte-level BPE vocabulary by its ranks; gives the same ids as the
    JSON file of that name, special token included, several times faster."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={"<|endoftext|>": 50256})


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text, end token included, as little-endian 32-bit numbers."""
    return np.array([*_encoder(path).encode(text, allowed_special="all"), END_ID], "<u4")


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, the first may
    be shorter."""
    first = n % capacity
    return [(0, first)] * (first > 0) + [(a, capacity) for a in range(first, n, capacity)]


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                ids = token_ids(text.decode(errors="replace"), path)
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start:start + length].tobytes()), part,
                                 seen[length]))
                    seen[length] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return run


def _knapsack(price: np.ndarray, most: np.ndarray, capacity: int) -> Counter:
    """Lengths of the largest total price that fit together, at most
    ``most[length]`` of each (copies are dealt in powers of two)."""
    items = []
    for l in np.flatnonzero((most > 0) & (price > 0)).tolist():
        copies, k = min(int(most[l]), capacity // l), 1
        while copies > 0:
            k = min(k, copies)
            items.append((l, k))
            copies -= k
            k *= 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)
    for i, (l, k) in enumerate(items):
        worth = best[:capacity + 1 - l * k] + price[l] * k
        np.greater(worth, best[l * k:], out=taken[i, l * k:])
        np.maximum(worth, best[l * k:], out=best[l * k:])  # ``worth`` is a copy: each item is used once
    out, room = Counter(), capacity
    for i in range(len(items) - 1, -1, -1):
        if taken[i, room]:
            l, k = items[i]
            out[l] += k
            room -= l * k
    return out


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY, price: np.ndarray | None = None) -> float:
    """No packing has fewer sequences: prices (by default the lengths) over the
    most that one configuration of any lengths is worth at them."""
    price = np.arange(capacity + 1) if price is None else price
    best = _knapsack(price, counts, capacity)
    worth = sum(price[l] * m for l, m in best.items())
    return float(price @ counts) / worth if worth > 0 else 0.0


def solve(counts: np.ndarray, capacity: int = CAPACITY, step: float = STEP, rate: float = RATE,
          tolerance: float = TOLERANCE, priced: int = PRICED) -> dict[tuple, float]:
    """Configuration LP: sequences of each configuration (tuple of lengths,
    longest first) that cover all but ``tolerance`` of the tokens.  No length is
    covered beyond its pieces; every step is at least one sequence and rounded
    down to whole ones."""
    rng = np.random.default_rng(17)
    lengths = np.arange(capacity + 1)
    left = counts.astype(float)
    price = lengths.astype(float)
    plan: dict[tuple, float] = defaultdict(float)
    while True:
        mass = np.where(left >= 1, left * lengths, 0.0)
        if mass.sum() <= tolerance * (counts @ lengths):
            return dict(plan)
        drawn = np.flatnonzero(mass)
        if len(drawn) > priced:  # weighted draw without replacement
            drawn = drawn[np.argsort(rng.exponential(size=len(drawn)) / mass[drawn])[:priced]]
        some = np.zeros(capacity + 1)
        some[drawn] = np.floor(left[drawn] + 1e-9)
        taken = _knapsack(price, some, capacity)
        most = min(left[l] / m for l, m in taken.items())  # never beyond what is left
        by = max(1.0, np.floor(min(most, step * min(counts[l] / m for l, m in taken.items())) + 1e-9))
        plan[tuple(sorted(taken.elements(), reverse=True))] += by
        for l, m in taken.items():
            left[l] -= by * m
            price[l] *= np.exp(-rate * by * m / counts[l])


def pack(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """(configuration, sequences) that hold exactly ``counts[length]`` pieces of
    every length; configurations list their lengths in place order."""
    left = counts.astype(np.int64).copy()
    full = int(left[capacity])
    left[capacity] = 0
    whole: list[tuple[tuple, int]] = [((capacity,), full)] if full else []
    groups: dict[int, Counter] = defaultdict(Counter)  # room left -> configurations -> sequences
    for shape, x in sorted(solve(left, capacity).items(), key=lambda kv: -kv[1]):
        times = min([int(x + 1e-9), *(int(left[l]) // m for l, m in Counter(shape).items())])
        if times > 0:
            for l, m in Counter(shape).items():
                left[l] -= times * m
            groups[capacity - sum(shape)][shape] += times
    rooms = sorted(groups)

    def put(room: int, shape: tuple, times: int) -> None:
        if room not in groups:
            bisect.insort(rooms, room)
        groups[room][shape] += times

    for l in range(capacity - 1, 0, -1):
        while left[l] > 0:
            i = bisect.bisect_left(rooms, l)
            if i == len(rooms):  # open new sequences, as many pieces each as fit
                each = min(capacity // l, int(left[l]))
                times = int(left[l]) // each
                put(capacity - each * l, (l,) * each, times)
                left[l] -= times * each
                continue
            room = rooms[i]
            shape, times = groups[room].popitem()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            each = min(room // l, int(left[l]))
            use = min(times, int(left[l]) // each)
            if times > use:
                put(room, shape, times - use)
            put(room - each * l, shape + (l,) * each, use)
            left[l] -= use * each
    return whole + [(shape, times) for room in sorted(groups) for shape, times in groups[room].items()]


def _table(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces a sequence, first sequence, first
    offset) sorted by length and rank: pieces of a length fill these in order."""
    used, rows, first = np.zeros(capacity + 1, np.int64), [], 0
    for shape, times in pack(counts, capacity):
        offset = 0
        for l, m in Counter(shape).items():
            rows.append((l, used[l], m, first, offset))
            used[l] += times * m
            offset += l * m
        first += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(table: np.ndarray):
    shift = 1 << 44
    keys = table[:, 0] * shift + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(keys, length * shift + rank, side="right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(row[:, 3] + nth // row[:, 2]), pa.array(row[:, 4] + nth % row[:, 2] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: doc_id, piece, start,
    length, ids_crc32, sequence_id, offset."""
    small_batches(docs.sparkSession)
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stage(pairs.mapInArrow(_pieces(vocabulary or vocabulary_file(), capacity),
                                    "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"),
                   "pieces")
    each = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = each.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most capacity rows
        counts[length] = n
    return (pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
            .mapInArrow(_place(_table(counts, capacity)),
                        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
