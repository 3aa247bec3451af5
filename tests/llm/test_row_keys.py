"""Rows that share a ``doc_id``, or have none: each is judged by its own text,
and a stage drops rows, never ids."""

import numpy as np
import pytest

import corpus_pipeline
from bookshift.llm import decontaminate, near_dedup
from tests.llm.test_edges import near_brute, words

A = " ".join(f"a{i}" for i in range(60))
B = " ".join(f"b{i}" for i in range(60))
SCHEMA = "doc_id long, text string, all boolean, gone long, __x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, True, k, f"r{k}") for k, (i, t) in enumerate(rows)], SCHEMA)


def test_near_classes_that_share_an_id(spark):
    rows = [(3, A), (9, A + " more"), (9, B), (9, B.upper()), (4, None), (None, A), (3, A), (12, B + " more")]
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == near_brute(rows)
    left = near_dedup.drop_near_duplicates(frame(spark, rows))
    assert left.columns == frame(spark, rows).columns
    kept = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    assert len(kept) == 4 and kept.count((3, A)) == 1 and (4, None) in kept and (None, A) in kept
    assert sum(i == 9 and t.lower() == B for i, t in kept) == 1


def test_near_threshold_is_a_parameter(spark):
    rng = np.random.default_rng(21)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for k in range(60):
        now = list(base)
        for j in rng.integers(0, 120, int(rng.integers(1, 6))):
            now[j] = f"n{k}"
        rows.append((int(rng.integers(0, 50)), " ".join(now)))
    for percent in (80, 95):
        got = near_dedup.near_duplicates(frame(spark, rows), percent).collect()
        assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == near_brute(rows, percent)
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(frame(spark, rows), 50)


def test_decontamination_drops_rows(spark):
    items = spark.createDataFrame([(1, A)], "item_id long, text string")
    rows = [(None, A), (None, "clean " + B), (5, A + " end"), (5, B), (6, ""), (None, None), (7, A)]
    left = decontaminate.drop_contaminated(frame(spark, rows), items)
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(
        [(None, "clean " + B), (5, B), (6, ""), (None, None)], key=str)
    assert decontaminate.drop_contaminated(frame(spark, rows), items.filter("false")).count() == len(rows)


def components_brute(rows, percent):
    """Rows that stay of (doc_id, text) rows: one a component."""
    out = [r for r in rows if r[0] is None or not words(r[1])]
    judged = [(i, t) for i, t in rows if i is not None and words(t)]
    sets = [near_brute([x], percent) and set(zip(*[t.lower().split()[k:] for k in range(5)])) or {tuple(t.lower().split())}
            for x in judged for t in [x[1]]]
    label = list(range(len(judged)))
    for _ in judged:
        for a in range(len(judged)):
            for b in range(a):
                if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
    for c in set(label):
        out.append(min((judged[k] for k in range(len(judged)) if label[k] == c),
                       key=lambda r: (r[0], near_dedup.text_print(r[1].encode()))))
    return sorted(out, key=str)


def test_stages_with_null_and_repeated_ids(spark, tmp_path):
    """The pipeline's stages on rows with null and repeated ids, extra columns
    and copies, each against a plain version of its rule."""
    rng = np.random.default_rng(22)
    rows = []
    for k in range(70):
        start = int(rng.integers(0, 6)) * 100
        now = [f"w{start + j}" for j in range(80)]
        for j in rng.integers(0, 80, int(rng.integers(0, 4))):
            now[j] = "changed"
        rows.append((None if k % 9 == 0 else int(rng.integers(0, 30)), " ".join(now)))
    rows += rows[:5] + [(None, None), (1, ""), (1, ""), (2, A), (2, B), (None, A), (3, A.upper())]
    docs = frame(spark, rows)
    sf = str(tmp_path)
    spark.createDataFrame([(1, A), (2, "w300 w301 w302 w303")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    stages = dict(corpus_pipeline.STAGES)

    once = stages["exact_dedup"](spark, docs, sf)
    last = {}
    for i, t in rows:
        last.setdefault((t or "").lower(), []).append(i)
    assert once.columns == docs.columns
    assert sorted(((r["doc_id"], (r["text"] or "").lower()) for r in once.collect()), key=str) == sorted(
        ((max((i for i in ids if i is not None), default=None), t) for t, ids in last.items()), key=str)

    near = stages["near_dedup"](spark, docs, sf)
    assert near.columns == docs.columns and pairs(near) == components_brute(rows, corpus_pipeline.NEAR_PERCENT)

    clean = stages["decontamination"](spark, docs, sf)
    items = [words(A), "w300 w301 w302 w303".split()]
    grams = {tuple(w[a:a + 13]) for w in items for a in range(max(len(w) - 13, 0) + 1)}

    def dirty(text):
        w = words(text)
        hit = {p for g in grams for a in range(len(w) - len(g) + 1) if tuple(w[a:a + len(g)]) == g for p in range(a, a + len(g))}
        return bool(hit) and 20 * len(hit) >= len(w)

    assert clean.columns == docs.columns and pairs(clean) == sorted((r for r in rows if not dirty(r[1])), key=str)
    for name in ("exact_dedup", "near_dedup", "decontamination"):
        assert stages[name](spark, docs.filter("false"), sf).count() == 0
