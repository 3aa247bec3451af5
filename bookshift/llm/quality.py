"""Document quality by a byte-level convolutional network in numpy.

Learned filters of ``WIDTH`` bytes run over every byte of the document.  The
text is cut into overlapping chunks that cover all of it; a filter's response
is max-pooled within a chunk, and the mean and the maximum over the chunks are
combined into one probability.

A filter is a table per byte place (byte embedding and filter weights
multiplied out), so scoring is table look-ups and additions; texts go in
segments, so memory stays the same for texts of any length.

Fitting uses at most ``SAMPLE`` labelled documents that are not held out,
drawn by a hash of ``doc_id``, each with all chunks of its whole text: fitting
and scoring pool over the same spans.  The driver holds the sampled texts once,
as bytes; responses are computed for ``SLICE`` chunks at a time, so a long text
costs time but no more memory.

Defined results: null and empty texts score as one chunk of padding; repeated
labels of a document count as their smallest; a null ``doc_id`` is not held
out and has no label; without labels of both kinds every score is the share of
label 1 (0.5 without any); an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookshift.llm.common import small_batches, texts
from bookshift.llm.toxicity import held_out

SAMPLE = 2500
FILTERS = 16
WIDTH = 5
EMBED = 6
#: responses are pooled by blocks; a chunk is CHUNK blocks, the next one
#: begins CHUNK - 1 blocks later, so neighbours share a block
BLOCK = 64
CHUNK = 8
SEGMENT = BLOCK * (CHUNK - 1) * 128
#: chunks whose responses are held at once while fitting
SLICE = 32
EPOCHS = 8
THRESHOLD = 0.7
PAD = 0


def chunks_of(text: bytes) -> np.ndarray:
    """All chunks of a text as rows of bytes (a view); a row reaches
    ``WIDTH - 1`` bytes further, so that a filter can start at every place."""
    step, span = BLOCK * (CHUNK - 1), BLOCK * CHUNK + WIDTH - 1
    n = -(-max(1, len(text) - BLOCK) // step)
    padded = np.full((n - 1) * step + span, PAD, np.uint8)
    padded[:min(len(text), len(padded))] = np.frombuffer(text, np.uint8)[:len(padded)]
    return np.lib.stride_tricks.sliding_window_view(padded, span)[::step]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(list(texts(b.column(0))), pa.binary()), b.column(1)], names=["bytes", "label"])


class Net:
    """Tables (place, byte, filter), filter biases, and the output layer over
    the mean and the maximum of the pooled responses."""

    def __init__(self, tables: np.ndarray, bias: np.ndarray, out: np.ndarray, shift: float):
        self.tables, self.bias, self.out, self.shift = tables, bias, out, shift

    def score(self, text: bytes) -> float:
        total, top, n = np.zeros(FILTERS), np.zeros(FILTERS), 0
        need = max(len(text) - BLOCK, 1)
        for a in range(0, need, SEGMENT):
            piece = np.frombuffer(text[a:a + SEGMENT + BLOCK + WIDTH - 1], np.uint8)
            chunks = -(-min(SEGMENT, need - a) // (BLOCK * (CHUNK - 1)))
            size = (chunks * (CHUNK - 1) + 1) * BLOCK
            padded = np.full(size + WIDTH - 1, PAD, np.uint8)
            padded[:min(len(piece), len(padded))] = piece[:len(padded)]
            seen = self.tables[0][padded[:size]]
            for k in range(1, WIDTH):
                seen += self.tables[k][padded[k:k + size]]
            blocks = seen.reshape(-1, BLOCK, FILTERS).max(axis=1)
            first = np.arange(chunks) * (CHUNK - 1)
            pooled = blocks[first]
            for k in range(1, CHUNK):
                np.maximum(pooled, blocks[first + k], out=pooled)
            pooled = np.maximum(pooled + self.bias, 0)
            total += pooled.sum(axis=0)
            top = np.maximum(top, pooled.max(axis=0))
            n += chunks
        z = float(np.concatenate([total / n, top]) @ self.out) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _strongest(tables: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(response, bytes under the filter) at the place of each chunk where each
    filter responds most; ``SLICE`` chunks at a time."""
    span, raw, under = BLOCK * CHUNK, [], []
    for a in range(0, len(data), SLICE):
        part = data[a:a + SLICE]
        seen = tables[0][part[:, :span]]
        for k in range(1, WIDTH):
            seen += tables[k][part[:, k:k + span]]
        won = seen.argmax(axis=1)  # chunk, filter
        raw.append(np.take_along_axis(seen, won[:, None, :], axis=1)[:, 0, :])
        under.append(np.stack([part[np.arange(len(part))[:, None], won + k] for k in range(WIDTH)]))
    return np.concatenate(raw), np.concatenate(under, axis=1)


def loss_and_gradient(p: dict[str, np.ndarray], data: np.ndarray, own: np.ndarray,
                      labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss of documents given by their chunks (``own``: the document
    of each chunk), and its gradient; a maximum passes its gradient to the place
    that won, shared evenly by chunks that tie."""
    n = len(labels)
    tables = np.einsum("be,kef->kbf", p["emb"], p["w"]).astype(p["emb"].dtype)
    best, under = _strongest(tables, data)
    raw = best + p["b"]
    pooled = np.maximum(raw, 0)
    count = np.bincount(own, minlength=n)[:, None]
    mean = np.zeros((n, FILTERS))
    np.add.at(mean, own, pooled)
    mean /= count
    top = np.zeros((n, FILTERS))
    np.maximum.at(top, own, pooled)
    is_top = pooled == top[own]
    ties = np.zeros((n, FILTERS))
    np.add.at(ties, own, is_top)
    both = np.concatenate([mean, top], axis=1)
    z = both @ p["out"] + p["c"][0]
    err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n
    g_mean, g_top = err[:, None] * p["out"][:FILTERS] / count, err[:, None] * p["out"][FILTERS:] / ties
    g_pool = (g_mean[own] + g_top[own] * is_top) * (raw > 0)
    g = {"out": both.T @ err, "c": np.array([err.sum()]), "b": g_pool.sum(axis=0),
         "emb": np.zeros_like(p["emb"]), "w": np.zeros_like(p["w"])}
    place = np.arange(FILTERS)
    for k in range(WIDTH):
        # response gradients gathered by byte: one row per byte value and filter
        by_byte = np.bincount((under[k].astype(np.int64) * FILTERS + place).ravel(), g_pool.ravel(),
                              256 * FILTERS).reshape(256, FILTERS)
        g["w"][k] = p["emb"].T @ by_byte
        g["emb"] += by_byte @ p["w"][k].T
    return float((np.logaddexp(0, z) - labels * z).mean()), g


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.03) -> Net:
    """``bags``: per document all its chunks (rows of bytes).  Adam on the log loss."""
    rng = np.random.default_rng(11)
    p = {"emb": rng.normal(0, 0.5, (256, EMBED)), "w": rng.normal(0, 0.3, (WIDTH, EMBED, FILTERS)),
         "b": np.zeros(FILTERS), "out": rng.normal(0, 0.1, 2 * FILTERS), "c": np.zeros(1)}
    p["c"][0] = np.log(labels.mean() / (1 - labels.mean()))
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    t = 0
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(bags)), max(1, len(bags) // 32)):
            data = np.concatenate([bags[i] for i in rows])
            own = np.repeat(np.arange(len(rows)), [len(bags[i]) for i in rows])
            single = {k: x.astype(np.float32) for k, x in p.items()}
            _, g = loss_and_gradient(single, data, own, labels[rows])
            t += 1
            step = rate * (1 - epoch / epochs) ** 0.5
            for key in p:
                m[key] += 0.1 * (g[key] - m[key])
                v[key] += 0.001 * (g[key] ** 2 - v[key])
                p[key] -= step * (m[key] / (1 - 0.9**t)) / (np.sqrt(v[key] / (1 - 0.999**t)) + 1e-8)
    return Net(np.einsum("be,kef->kbf", p["emb"], p["w"]).astype(np.float32), p["b"].astype(np.float32), p["out"],
               float(p["c"][0]))


def _constant(share: float) -> Net:
    return Net(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS),
               float(np.log(share / (1 - share))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Net:
    small_batches(docs.sparkSession)
    marks = (labels.select(F.col("doc_id").cast("long").alias("lid"), F.col("quality").cast("int").alias("label"))
             .filter(F.col("lid").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("lid")))
             .groupBy("lid").agg(F.min("label").alias("label")))
    ids = docs.select(F.col("doc_id").cast("long").alias("did")).distinct()
    drawn = marks.join(ids, F.col("lid") == F.col("did")).orderBy(F.xxhash64("lid"), "lid").limit(sample)
    made = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(drawn), F.col("doc_id") == F.col("lid")).select("text", "label")
            .mapInArrow(_whole, "bytes binary, label int"))
    bags, known = [], []
    for r in made.toLocalIterator():
        bags.append(chunks_of(bytes(r["bytes"])))
        known.append(r["label"])
    known = np.array(known, float)
    if not len(known) or known.min() == known.max():
        return _constant(0.5 if not len(known) else float(np.clip(known.mean(), 0.01, 0.99)))
    return fit(bags, known)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, held_out, score (higher: label 1
    likelier), predicted."""
    net = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([net.value.score(t) for t in texts(b.column(1))], pa.float64())],
                names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
