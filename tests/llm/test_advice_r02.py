"""Findings of the second advice: each test failed before its change."""

import numpy as np

from bookshift.llm import licenses, secrets, toxicity


def test_toxicity_learns_rare_words():
    """Words of a twentieth of the positives count where clean texts lack them."""
    rng = np.random.default_rng(1)
    words = rng.integers(1, 2**62, 400).astype(np.uint64)
    marks, plain = words[:20], words[20:]

    def doc(mark=None):
        said = rng.choice(plain, 30, replace=False)
        return np.unique(said if mark is None else np.append(said, mark))

    positive = [doc(rng.choice(marks)) for _ in range(300)]
    unlabelled = [doc(rng.choice(marks) if k % 20 == 0 else None) for k in range(3000)]
    model = toxicity.fit(positive, unlabelled, 0.1)
    flagged = lambda sets: (toxicity._sigmoid(model.output(sets)) >= toxicity.THRESHOLD).mean()
    assert flagged([doc(m) for m in marks]) > 0.9
    assert flagged([doc() for _ in range(500)]) < 0.03


def test_toxicity_recall_by_language(spark):
    from bookshift.llm.queries import QUERIES

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").filter("held_out").select("doc_id", "predicted")
    judged = scored.join(labels.select("doc_id", "toxic"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("en", "de", "fr", "es"):
        toxic = [r["predicted"] for r in judged if r["toxic"] == 1 and r["lang"] == lang]
        clean = [r["predicted"] for r in judged if r["toxic"] == 0 and r["lang"] == lang]
        assert sum(toxic) / len(toxic) > 0.5, lang
        assert sum(clean) / len(clean) < 0.05, lang


def test_license_every_notice_of_a_file(spark):
    """A file with all notices in a row gives all their labels; common notice
    words elsewhere take no places away."""
    notices = [t for _, _, t in licenses.NOTICES]
    rows = [(1, " filler ".join(notices)), (2, notices[0] + " filler " + notices[-1])]
    rows += [(10 + k, "copyright reserved rights " + "by cc licensed") for k in range(20)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["labels"] == ",".join(sorted({label for label, _, _ in licenses.NOTICES}))
    assert got[2]["labels"] == "mit,proprietary"
    assert got[10]["labels"] == ""


def test_secret_whole_value_and_prefixed_words():
    spans = lambda t: [(k, t[a:z]) for k, a, z, *_ in secrets.find(t)]
    assert spans(b"password: abcdef!X9#kQ2vLp") == [("assign", b"password: abcdef"), ("guess", b"abcdef!X9#kQ2vLp")]
    assert spans(b"password: abcdefX9kQ2vLp.") == [("assign", b"password: abcdefX9kQ2vLp.")]
    for word in (b"DB_PASSWORD=", b"DB_PWD=", b"MYSQL_PWD=", b"USER_PIN=", b"db2pwd="):
        assert spans(word + b"Tr!v0x#92kQ") == [("guess", b"Tr!v0x#92kQ")]
    assert spans(b"spin: Tr!v0x#92kQ") == []
