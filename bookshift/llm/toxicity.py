"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, other documents the unlabelled
mixture; nobody vouches for a clean example.  With class prior ``pi`` the risk
of a scorer g is

    pi * R_p(g, +) + max(0, R_u(g, -) - pi * R_p(g, -)),

where the second term estimates the risk on clean documents and is kept from
going negative (when it does, the step climbs back out of it).  The scorer is
linear over the distinct words of the whole text (by 64-bit hash), the loss
logistic, so the sigmoid of its output estimates the probability of the class.

Fitting uses at most ``POSITIVES`` and ``UNLABELLED`` documents, drawn by a
hash of ``doc_id`` from the rows that are not held out; their features are made
in tasks, the driver receives hashes only.  The prior is
the toxic share of the labels that may be learnt from.  Scoring goes over
every whole text, task by task, without a shuffle.

Defined results: null, empty and word-free texts score the model's base rate;
repeated labels of a document count as toxic if one is; a null ``doc_id`` is
not held out and has no label; without a positive example every score is 0;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookshift.llm.common import small_batches, texts
from bookshift.llm.rolling import word_hashes

POSITIVES = 3000
UNLABELLED = 9000
STEPS = 80
#: penalties that validation chooses from, in standard errors of a word's share
SPARSITY = (0.5, 1.0, 1.5, 2.0, 3.0, 4.0)
#: one fitting row in so many validates the penalty
VALIDATE = 4
PICKED = 0.1
LEAST_SEEN = 5
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows whose labels nothing learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(text: bytes) -> np.ndarray:
    """Hashes of the distinct words of a text."""
    return np.unique(word_hashes(text))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([features(t).tobytes() for t in texts(b.column(0))], pa.binary()),
                                          b.column(1)], names=["hashes", "positive"])


def _numbered(sets: list[np.ndarray], words: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, word number) of every known word of every set, and the number of rows."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    found = np.concatenate([np.empty(0, np.uint64), *sets])
    at = np.minimum(np.searchsorted(words, found), len(words) - 1)
    known = words[at] == found
    return rows[known], at[known], len(sets)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(both: list[tuple], prior: float, allowed: np.ndarray, sparsity: np.ndarray, steps: int) -> np.ndarray:
    """Accelerated proximal gradient steps on the non-negative risk with an
    L1 penalty for each word, over the allowed words; the last weight is the
    bias."""
    size = len(allowed)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    ahead, pace = w.copy(), 1.0
    # a step for each word by its own curvature bound: rare words move far, common ones little
    rows, word, n = both[1]
    heavy = 1 + np.bincount(rows, allowed[word].astype(float), n)
    bend = np.append(np.bincount(word, heavy[rows], size), heavy.sum()) / (4 * n)
    rate = 1 / np.maximum(bend, 1e-3)
    for _ in range(steps):
        zp, zu = (np.bincount(r, ahead[x], n) + ahead[-1] for r, x, n in both)
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if clean >= 0:
            gp, gu = np.full(len(zp), -prior / len(zp)), _sigmoid(zu) / len(zu)
        else:  # the clean risk is overfitted below zero: step back up
            gp, gu = prior * _sigmoid(zp) / len(zp), -_sigmoid(zu) / len(zu)
        grad = sum(np.bincount(x, g[r], size + 1) for (r, x, _), g in zip(both, (gp, gu)))
        grad[-1] = gp.sum() + gu.sum()
        new = ahead - rate * grad
        body = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate[:-1] * sparsity, 0)
        new[:-1] = np.where(allowed, body, 0)
        after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / after * (new - w)
        w, pace = new, after
    return w


class Model:
    """Sorted word hashes with their weights, and a bias."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, bias: float):
        self.words, self.weights, self.bias = words, weights, bias

    def output(self, sets: list[np.ndarray]) -> np.ndarray:
        if not len(self.words):
            return np.full(len(sets), self.bias)
        rows, word, n = _numbered(sets, self.words)
        return np.bincount(rows, self.weights[word], n) + self.bias

    def score(self, column) -> np.ndarray:
        return _sigmoid(self.output([features(t) for t in texts(column)]))


def _fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int, sparsity: float) -> Model:
    """The words are those of at least ``LEAST_SEEN`` positives.  The penalty
    of a word follows the noise in its own share among ``n`` positives, ``prior
    * sqrt(share * (1 - share) / n)``, so a rare word needs as many standard
    errors as a common one: it picks the words that speak; a second descent
    over these alone takes its shrinkage back."""
    words, seen = np.unique(np.concatenate(positive), return_counts=True)
    words = words[seen >= LEAST_SEEN]
    if not len(words):
        return Model(words, np.empty(0), float(np.log(prior / (1 - prior))))
    both = [_numbered(sets, words) for sets in (positive, unlabelled)]
    held = sum(np.bincount(word, minlength=len(words)) for _, word, _ in both)
    share = held / (len(positive) + len(unlabelled))
    noise = sparsity * prior * np.sqrt(share * (1 - share) / len(positive))
    speak = np.abs(_descend(both, prior, np.ones(len(words), bool), noise, steps)[:-1]) > PICKED
    w = _descend(both, prior, speak, noise / 10, steps)
    return Model(words[speak], w[:-1][speak], float(w[-1]))


def _risk(model: Model, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> float:
    """Non-negative risk with the logistic loss."""
    zp, zu = (model.output(sets) for sets in (positive, unlabelled))
    clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    return float(prior * np.logaddexp(0, -zp).mean() + max(0.0, clean))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = STEPS,
        sparsity: tuple[float, ...] = SPARSITY) -> Model:
    """Fit with the penalty that has the least risk on every ``VALIDATE``-th
    row when fitted on the others; the final model is fitted on all rows."""
    def risk(scale: float) -> float:
        kept = [[s for k, s in enumerate(sets) if k % VALIDATE] for sets in (positive, unlabelled)]
        return _risk(_fit(*kept, prior, steps, scale), positive[::VALIDATE], unlabelled[::VALIDATE], prior)

    if min(len(positive), len(unlabelled)) <= VALIDATE:
        return _fit(positive, unlabelled, prior, steps, sparsity[-1])
    return _fit(positive, unlabelled, prior, steps, min(sparsity, key=risk))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on rows that are not held out; labels are read as "confirmed toxic"
    or nothing."""
    small_batches(docs.sparkSession)
    marks = (labels.select(F.col("doc_id").cast("long").alias("lid"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("lid").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("lid")))
             .groupBy("lid").agg(F.max("toxic").alias("toxic")))
    prior = marks.agg(F.avg("toxic")).first()[0]
    if not prior:
        return Model(np.empty(0, np.uint64), np.empty(0), -30.0)
    ids = docs.select(F.col("doc_id").cast("long").alias("did")).filter(
        F.col("did").isNotNull() & ~held_out(F.col("did"))).distinct()
    known = ids.join(marks.filter("toxic = 1"), F.col("did") == F.col("lid"), "left")
    drawn = lambda df, n: df.orderBy(F.xxhash64("did"), "did").limit(n)
    sample = drawn(known.filter("lid is not null").select("did", F.lit(True).alias("positive")), positives).union(
        drawn(known.filter("lid is null").select("did", F.lit(False).alias("positive")), unlabelled))
    made = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(sample), F.col("doc_id") == F.col("did")).select("text", "positive")
            .mapInArrow(_featurise, "hashes binary, positive boolean"))
    sides: dict[bool, list] = {True: [], False: []}
    for r in made.toLocalIterator():
        sides[r["positive"]].append(np.frombuffer(r["hashes"], np.uint64))
    if not sides[True] or not sides[False]:
        return Model(np.empty(0, np.uint64), np.empty(0), -30.0)
    return fit(sides[True], sides[False], min(float(prior), 0.99))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.value.score(b.column(1)))],
                                             names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns kept; each row is
    judged by its own text."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.value.score(b.column(at).cast(pa.string())) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
