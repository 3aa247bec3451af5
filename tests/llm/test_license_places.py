"""Licence notices against a plain count over every place of every file."""

import numpy as np

from bookshift.llm import licenses
from tests.llm.test_edges import words


def brute(text):
    w = words(text)
    labels, cover, notices = set(), 0.0, {}
    for n, label, key, key_at, size, votes, j, word in licenses.rules()[1]:
        notices.setdefault((n, label, key, key_at, size, votes), []).append((j, word))
    for (n, label, key, key_at, size, votes), own in notices.items():
        want = key.split()
        spots = [p for p in range(len(w)) if w[p:p + len(want)] == want]
        for at in {s - key_at + d for s in spots for d in range(-licenses.SLACK, licenses.SLACK + 1)}:
            stand = sum(0 <= at + j < len(w) and w[at + j] == word for j, word in own)
            if stand >= votes:
                labels.add(label)
                cover = max(cover, stand / size)
    return labels, cover


def test_notices_against_every_place(spark):
    rng = np.random.default_rng(31)
    notices = [t for _, _, t in licenses.NOTICES]
    texts = [*notices, *[" filler ".join(rng.permutation(notices)[:3]) for _ in range(10)],
             "licensed under cc by nc 4 0", "licensed under cc by sa 4 0", "licensed under cc by", "licensed under CC-BY 4.0",
             "permission is hereby granted free of charge", "the apache license", None, "software license copyright " * 50]
    for _ in range(60):  # notices with words lost, changed and put in
        w = rng.choice(notices).split()
        for _ in range(int(rng.integers(0, 8))):
            k, kind = int(rng.integers(0, len(w))), int(rng.integers(0, 3))
            w[k:k + (kind > 0)] = [str(rng.choice(["software", "copy", "license", "other", "rights"]))] * (kind < 2)
            w = w or ["x"]
        texts.append(" ".join([*rng.choice(["copy", "software", "version", "pad"], 5), *w, "end"]))
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        labels, cover = brute(texts[r["doc_id"]])
        base = set(filter(None, r["base_labels"].split(",")))
        assert r["labels"] == ",".join(sorted(labels | base)), texts[r["doc_id"]]
        assert abs(r["score"] - (cover or (licenses.PHRASE_SCORE if r["n_base"] else 0.0))) < 1e-12


def test_look_alike_licences(spark):
    rows = [(1, "licensed under cc by nc 4 0"), (2, "licensed under cc by sa 4 0"), (3, "licensed under CC BY 4.0"),
            (4, "permission is hereby granted free of charge")]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "cc-by-nc", 2: "cc-by-sa", 3: "cc-by", 4: ""}
