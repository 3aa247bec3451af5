"""Secrets: fixed patterns, and values in credential context that are too
costly to guess.

A value that follows a credential word (``pwd: x``, ``passphrase is x``, ...)
is cut into words, dates, repeats, keyboard walks, sequences and brute-force
characters; dynamic programming over every place and length of each kind of
piece finds the cheapest cut, as log10 of the guesses an attacker needs.  A
quoted value goes to its closing quote on the line, blanks and commas
included; any other ends at a blank, quote, comma, semicolon, ``<`` or ``>``.  Values of at least ``MIN_COST`` are secrets; a
placeholder such as ``password: changeme1`` is not.  The fixed patterns are
reported whatever they cost, with their cost beside them.

The work is per document: one scan, no shuffle, memory of one Arrow batch.

Defined results: null and empty texts have no spans; a pattern's matches are
leftmost and do not overlap within their kind; a costed value inside an
``assign`` span is that span, one that goes on beyond it is reported as well; every input row gives one row, also where
``doc_id`` is null or repeats; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookshift.llm.common import small_batches, texts

#: log10 of the guesses from which a value in credential context is a secret
MIN_COST = 10.0

ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")   # same as 20+ of AKIA[A-Z0-9]+: runs are maximal
HEX = re.compile(rb"[0-9a-f]{24,}")          # likewise
CONTEXT = re.compile(
    rb"""(?i:(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[ _-]?key|auth[ _-]?key|login[ _-]?key|pin)"""
    rb"""["']?[\x20\t]*(?:[:=]|=>|->|\bis\b)[\x20\t]*)"""
    rb"""(?:"((?:[^"\\\r\n]|\\.){6,})"|'((?:[^'\\\r\n]|\\.){6,})'|["']?([^\s"'<>,;]{6,}))""")

# Words that guessing tools try first, most common first.
COMMON = """password pass admin welcome login letmein monkey dragon master love secret hello shadow sunshine princess
football baseball superman batman iloveyou trustno hunter killer soccer hockey ranger jordan harley test guest root
user default changeme change example sample demo temp temporary server system access open door key word summer winter
spring autumn january february march april may june july august september october november december monday friday
sunday money freedom whatever computer internet cheese coffee orange banana purple silver golden black white green
red blue dog cat star angel baby family flower the and you me my your this that not new old big one two three four
five six seven eight nine ten your here value string token none null true false placeholder dummy fake""".split()
WORDS = {w: math.log10(i + 2) for i, w in reversed(list(enumerate(COMMON)))}
LONGEST = max(map(len, WORDS))
LEET = str.maketrans("@4301!$57", "aaeolisst")
# The rows of a keyboard.
KEYS = {c: (x + y / 2, y) for y, row in enumerate(("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./"))
        for x, c in enumerate(row)}
DATE = re.compile(r"(?:19|20)\d\d[-/.]?[01]?\d[-/.]?[0-3]?\d|[0-3]?\d[-/.][01]?\d[-/.](?:19|20)?\d\d|(?:19|20)\d\d")
DATE_LENGTHS = range(4, 11)
#: Repeats, sequences and walks of the guess model are this long at most; a
#: longer run is several of them.
LONGEST_RUN = 64


def _brute(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def _runs(v: str, low: str, i: int) -> Iterator[tuple[int, float]]:
    """(end, cost) of every repeat, sequence and keyboard walk of three or more
    characters that starts at ``i``."""
    last = min(len(v), i + LONGEST_RUN)
    repeat = low[i + 1:i + 2] == low[i]
    step = None if repeat or i + 1 >= len(v) else ord(low[i + 1]) - ord(low[i])
    if repeat or step in (1, -1):
        base = _brute(v[i]) if repeat else math.log10(52)
        j = i + 1
        while j < last and ord(low[j]) - ord(low[j - 1]) == (0 if repeat else step):
            j += 1
            if j - i >= 3:
                yield j, base + math.log10(j - i)
    turns, way, j = 0, None, i + 1
    while j < last:
        p, q = KEYS.get(low[j - 1]), KEYS.get(low[j])
        if not p or not q or p == q or abs(p[0] - q[0]) > 1 or abs(p[1] - q[1]) > 1:
            break
        move = (q[0] - p[0], q[1] - p[1])
        turns, way, j = turns + (move != way), move, j + 1
        if j - i >= 3:
            yield j, math.log10(47) + 0.6 * turns + math.log10(j - i)


def guess_cost(value: str, enough: float = math.inf) -> float:
    """log10 of the guesses of the cheapest cut.  Costs only add up, so the
    search ends as soon as every cut has come to ``enough``."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(LEET)
    best = [math.inf] * (len(value) + 1)
    best[0] = 0.0
    reach = 0  # furthest cut that is open
    for i in range(len(value)):
        here = best[i]
        steps = [(i + 1, _brute(value[i])), *_runs(value, low, i)]
        if value[i].isdigit():
            steps += [(i + n, math.log10(366 * 120)) for n in DATE_LENGTHS
                      if i + n <= len(value) and DATE.fullmatch(value, i, i + n)]
        for j in range(i + 2, min(len(value), i + LONGEST) + 1):
            if (cost := WORDS.get(plain[i:j])) is not None:
                steps.append((j, cost + 0.3 * (value[i:j] != low[i:j]) + 0.3 * (low[i:j] != plain[i:j])))
        for j, cost in steps:
            best[j] = min(best[j], here + cost)
            reach = max(reach, j)
        if min(best[i + 1:reach + 1]) >= enough:
            return enough
    return best[-1]


def find(text: bytes) -> list[tuple[str, int, int, bool, float]]:
    """(kind, start, end, base, cost) in bytes, by start, then kind."""
    found = []
    taken = []
    for m in ASSIGN.finditer(text):
        if len(m[1]) >= 6:
            taken.append(m.span())
            found.append(("assign", *m.span(), True, m[1]))
    found += [("access", *m.span(), True, m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), True, m[0]) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        a, z = m.span(m.lastindex)
        value = m[m.lastindex] if m.lastindex < 3 else m[3].rstrip(b".!?)]}")
        if not any(s <= a and a + len(value) <= e for s, e in taken):
            found.append(("guess", a, z, False, value))
    order = {"assign": 0, "access": 1, "hex": 2, "guess": 3}
    costed = [(k, a, a + len(v) if k == "guess" else z, base, guess_cost(v.decode(errors="replace"), 40.0))
              for k, a, z, base, v in found]
    return sorted((x for x in costed if x[3] or x[4] >= MIN_COST and x[2] - x[1] >= 6), key=lambda x: (x[1], order[x[0]]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                   ("log10_guesses", pa.float64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text in texts(b.column(1)):
            spans = find(text)
            if spans and not text.isascii():  # bytes to code points: count the bytes that begin one
                begun = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
                at = np.concatenate(([0], begun))
                spans = [(k, int(at[a]), int(at[z]), base, cost) for k, a, z, base, cost in spans]
            rows.append([dict(zip(("kind", "start", "end", "base", "log10_guesses"), s)) for s in spans])
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(rows, pa.list_(_SPAN))],
                                         names=["doc_id", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, spans: array of kind (assign, access,
    hex, guess), start and end (code points, end exclusive), base,
    log10_guesses (40 stands for 40 or more)."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean,log10_guesses:double>>")


def digest(docs: DataFrame) -> DataFrame:
    """Columns of the registered query."""
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return secret_spans(docs).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), listed("spans").alias("spans"))
