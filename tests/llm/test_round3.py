"""Substring dedup, spelling variants and the filter audit against brute force,
with nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing columns."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from bookshift.llm import filter_audit, spelling, substring_dedup
from tests.llm.test_edges import LONG, SCHEMA, rows_of

PASSAGE = " ".join(f"p{i}" for i in range(70))


def blank_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def sha(words):
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "xx", False, 1, 0.5, 7, "g") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def copies(spark):
    rng = np.random.default_rng(11)
    pool = [f"w{i}" for i in range(3000)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, LONG), (6, LONG + " end"), (7, "intro " + PASSAGE + " tail"),
            (8, PASSAGE), (8, PASSAGE), (8, PASSAGE.replace("p30 ", "other ")), (9, PASSAGE), (None, PASSAGE), (None, PASSAGE),
            (None, PASSAGE + " x " + PASSAGE), (10, "a " * 60), (11, "a " * 45), (12, " ".join(f"p{i}" for i in range(20))),
            (13, " ".join(f"p{i}" for i in range(19))), (14, PASSAGE.replace(" ", "\t ").upper()), (15, PASSAGE.replace(" ", " \n")),
            (16, "é ".join(["word"] * 40)), (17, "b c " * 30), (18, PASSAGE + "\x00 \u0085 " + PASSAGE)]
    for k in range(40):  # passages met at many places, cut and changed
        words = []
        for _ in range(int(rng.integers(1, 5))):
            a = int(rng.integers(0, 2900))
            words += pool[a:a + int(rng.integers(5, 90))]
        words[int(rng.integers(0, len(words)))] = f"own{k}"
        rows.append((int(rng.integers(20, 55)), " ".join(words)))
    return rows


def substring_brute(rows):
    starts = {}
    for n, (i, t) in enumerate(rows):
        w = blank_words(t)
        for a in range(len(w) - 19):
            starts.setdefault(tuple(w[a:a + 20]), []).append((n, i, a))
    out = []
    for n, (i, t) in enumerate(rows):
        w, gone = blank_words(t), set()
        for a in range(len(w) - 19):
            for m, j, b in starts[tuple(w[a:a + 20])]:
                if (m == n and b < a) or (i is not None and j is not None and j < i):
                    gone |= set(range(a, a + 20))
                    break
        out.append((i, len(w), len(gone), sha([x for p, x in enumerate(w) if p not in gone])))
    return sorted(out, key=str)


def test_substring_dedup_against_brute_force(spark, copies):
    got = rows_of(substring_dedup.deduplicate(frame(spark, copies)))
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=str) == substring_brute(copies)
    assert all(r["kept"] is None or sha(blank_words(r["kept"])) == r["kept_sha256"] for r in got)
    assert substring_dedup.deduplicate(frame(spark, copies).filter("false")).count() == 0


def test_substring_paths_are_compacted(spark):
    """Whole copies are one unit each, however long; a changed word cuts them."""
    docs = [(k, PASSAGE) for k in range(5)] + [(9, " ".join(f"q{i}" for i in range(90)))]
    _, units = substring_dedup.repeated_units(frame(spark, docs))
    assert sorted((r["doc_id"], r["first"], r["last"]) for r in units.collect()) == [(k, 0, 50) for k in range(5)]
    _, units = substring_dedup.repeated_units(frame(spark, docs + [(10, PASSAGE.replace("p60 ", "new "))]))
    whole = [r for r in units.collect() if r["last"] > r["first"]]
    assert whole and len({(r["first"], r["last"]) for r in whole}) < 5


def test_pieces_of_long_texts_equal_whole(monkeypatch):
    data = " ".join(blank_words(LONG)[:6000]).encode()
    spans = substring_dedup.word_spans(data)
    whole = substring_dedup.pieces(data, *spans)
    monkeypatch.setattr(substring_dedup, "PIECE", 300)
    assert all((a == b).all() for a, b in zip(whole, substring_dedup.pieces(data, *spans)))
    _, _, first, last = whole
    assert first[0] == 0 and last[-1] == len(spans[0]) - 20 and (first[1:] == last[:-1] + 1).all()


def edits(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def spelling_brute(rows):
    counts = {}
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    near = {w: [v for v in counts if edits(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out, key=str)


def test_spelling_against_brute_force(spark):
    rng = np.random.default_rng(12)
    letters = list("abcdeéÀ×")
    base = ["".join(rng.choice(letters, int(rng.integers(4, 9)))) for _ in range(25)]
    said = []
    for w in base:
        for _ in range(8):
            v = list(w)
            k, kind = int(rng.integers(0, len(v))), int(rng.integers(0, 3))
            v[k:k + (kind > 0)] = [str(rng.choice(letters))] * (kind < 2)
            said += ["".join(v)] * int(rng.integers(1, 9))
        said += [w] * int(rng.integers(3, 60))
    said += ["abab" * 3 + x for x in ("a", "b", "ab", "ba") for _ in range(4)]
    said += ["aaaaa"] * 3 + ["aaaaaa"] * 6 + ["aaaaaaa"] * 12 + ["aaaaaaaa"] * 24 + ["aaaaaaaaa"] * 48  # a chain of forms
    rng.shuffle(said)
    rows = [(k % 37 if k % 5 else None, " ".join(said[k:k + 9]).title() + ", x1y2 Ünïcode") for k in range(0, len(said), 9)]
    rows += [(1, None), (2, ""), (3, "123 !?"), (3, "z" * 100_000 + " " + "z" * 100_000 + " " + "z" * 100_000)]
    got = rows_of(spelling.variants(frame(spark, rows)))
    assert sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got), key=str) == spelling_brute(rows)
    assert any(r["root"] not in (r["word"], r["form"]) for r in got)
    assert spelling.variants(frame(spark, rows).filter("false")).count() == 0


def test_signatures_lose_no_pair(spark):
    """Words one edit apart share a signature, wherever the edit is."""
    rng = np.random.default_rng(13)
    parts = ["aeqbfr", "cgédhx", "ijk"]
    letters = list("".join(parts))
    pairs = []
    for _ in range(3000):
        a = "".join(rng.choice(letters, int(rng.integers(5, 12))))
        k, kind = int(rng.integers(0, len(a) + 1)), int(rng.integers(0, 3))
        b = a[:k] + ("" if kind == 2 else str(rng.choice(letters))) + a[k + (kind > 0):]
        if a != b and len(b) >= 5:
            pairs.append((a, b))
    words = spark.createDataFrame(sorted({(w, 3) for p in pairs for w in p}), "word string, n long")
    keys = {}
    for r in spelling.signatures(words, parts).collect():
        keys.setdefault(r["word"], set()).add(r["key"])
    assert all(keys[a] & keys[b] for a, b in pairs)
    assert {len(k) for k in keys.values()} <= set(range(15, 22))


def audit_brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for n, (i, text, lang) in enumerate(rows):
        t, w = text or "", blank_words(text)
        fails = {"A"} if len(w) < 200 else set()
        fails |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        fails |= {"D"} if re.search("[#$%&*|]", t) else set()
        if any((u or "") == t and i is not None and j is not None and j < i for j, u, _ in rows):
            fails.add("E")
        docs.append((lang or "", fails, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        mine, table, share = [d for d in docs if d[0] == part], [], {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                redundant = sum(letter in d[1] and bool(d[1] & set(order[:step - 1])) for d in mine)
                left = [d for d in left if letter not in d[1]]
                share[letter] = share.get(letter, 0) + len(gone)
                table.append((part, order, step, len(left), len(gone), redundant, sum(d[1] == {letter} for d in mine),
                              sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*r, share[r[1][r[2] - 1]]) for r in table]
    return sorted(out, key=str)


def test_filter_audit_against_brute_force(spark):
    many = " ".join(f"t{i}" for i in range(250))
    rows = [(1, None, "en"), (2, "", None), (3, many, "en"), (4, many, "en"), (4, many, "de"), (5, many + " #", ""),
            (6, many.upper(), "en"), (7, "a " * 300, "en"), (7, "a " * 300, "en"), (8, "a " * 300, "fr"), (None, many, "en"),
            (None, many, "en"), (9, LONG, "fr"), (10, LONG, "fr"), (11, "A" * 40, None), (12, "Ünder   100%", "en"),
            (13, (many + " ") * 2, "en"), (14, (many + " ") * 3, "en"), (15, many.replace("t1 ", "T1 "), "en")]
    rows += [(k, many, "hot") for k in range(100, 180)]
    labels = [(3, 1, 0), (4, 1, 1), (4, 0, None), (7, None, 1), (None, 1, 1), (9, 1, 0), (150, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 3, True) for r in rows],
                                 "doc_id long, text string, lang string, part string, step int, good boolean")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, known)
    cols = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == audit_brute(rows, labels)
    assert filter_audit.audit(docs.filter("false"), known).count() == 0
    assert filter_audit.audit(docs, known.filter("false")).filter("good_lost + toxic_lost > 0").count() == 0
