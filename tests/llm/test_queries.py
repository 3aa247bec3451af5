"""The registered queries on the given tables: DuckDB where SQL can say it,
held-out accuracy for the classifiers, brute force for the rest."""

import os
import sys
import zlib

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from bookshift.llm.queries import ORACLE, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "pages"):
        c.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    got = QUERIES[name](spark, SMALL)
    cols = got.columns
    want = con.execute(ORACLE[name])
    assert sorted(d[0] for d in want.description) == sorted(cols)
    at = [[d[0] for d in want.description].index(c) for c in cols]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


def held(spark, name, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    scored = QUERIES[name](spark, "/root/testdata/sf0.1").collect()
    assert len(scored) == 10_000
    return [(r["predicted"], labels[r["doc_id"]], r["doc_id"]) for r in scored if r["held_out"] and r["doc_id"] in labels]


def test_quality_on_held_out_labels(spark):
    judged = held(spark, "op6_quality_classifier", "quality")
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for _, _, i in judged)
    assert sum(p == y for p, y, _ in judged) / len(judged) > 0.97


def test_toxicity_on_held_out_labels(spark):
    judged = held(spark, "op10_toxicity", "toxic")
    clean = [p for p, y, _ in judged if y == 0]
    toxic = [p for p, y, _ in judged if y == 1]
    assert sum(clean) / len(clean) < 0.03 and sum(toxic) / len(toxic) > 0.45  # some labels are noise


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from bookshift.llm import toxicity
    from tests.llm.test_edges import near_brute, plain, words

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.train(docs, labels)
    import pyarrow as pa

    order = sorted(texts)
    clean = [i for i, s in zip(order, model.score(pa.array([texts[i] for i in order]))) if s < toxicity.THRESHOLD]
    last = {plain(texts[i]): i for i in clean}
    kept = sorted(last.values())
    kept = [i for i, _, c in near_brute([(i, texts[i]) for i in kept], 80) if i == c]
    items = [w for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() for w in [words(r["text"])] if w]
    grams = {tuple(w[a:a + 13]) for w in items for a in range(max(len(w) - 13, 0) + 1)}
    sizes = {len(g) for g in grams}

    def contaminated(w):
        hit = {p for n in sizes for a in range(len(w) - n + 1) if tuple(w[a:a + n]) in grams for p in range(a, a + n)}
        return bool(hit) and 20 * len(hit) >= len(w)

    want = {i for i in kept if not contaminated(words(texts[i]))}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
