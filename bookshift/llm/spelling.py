"""Spelling variants by PartEnum signatures over letter multisets.

1. Words are counted over all texts (partial sums in the map tasks).
2. A word's letter multiset is a binary vector with one place for each letter
   and repetition.  Words that differ by one replaced code point have the same
   length and vectors at Hamming distance two; by one inserted or deleted
   code point, lengths one apart and distance one.  The letters are dealt into
   three parts of about equal use, so each part holds some places of the
   vector.  At distance two one of the three parts is equal; at distance one
   the first part is, or the other two are.  A word's letters in those parts
   are its exact signatures, enumerated for each size.
3. Many words are made of the same letters, so a signature also names a third
   of the word that is left out: one edit leaves the other two as they were,
   counted from the start before it and from the end behind it.  That splits
   long lists, and no pair is lost by it.
4. Words with equal signatures are joined by equality, and the edit distance
   is tested within the join: only true pairs leave it.
5. A word's form is its near word of largest count; roots are found by
   doubling the steps along the forms, which at least double in count.

Defined results: null and empty texts and texts without letters have no words;
a null ``doc_id`` reads as an empty one in the slip rule; rows that share a
``doc_id`` and repeated rows count each for itself; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookshift.llm.common import lower_ascii, stage

LETTERS = "[a-zÀ-ÿ]+"
#: one run in so many, by the checksum of its document and letters, loses a code point
SLIP = 97
MIN_LENGTH = 5
MIN_COUNT = 3
#: a form stands so many times as often as the word, at least
RATIO = 2
PARTS = 3


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of at least ``MIN_LENGTH`` code points and their
    number over all texts, from ``MIN_COUNT`` up."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower_ascii(F.col("text").cast("string")), F.lit(LETTERS), F.lit(0))).alias("run"))
    check = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = F.pmod(check, F.char_length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return (runs.select(F.when(check % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
            .filter(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


def letter_parts(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The letters in use (at most 90, by the word rule), dealt into parts of
    about equal use."""
    used = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    out, weight = [""] * parts, [0] * parts
    for letter, n in sorted(used, key=lambda r: (-r[1], r[0])):
        k = weight.index(min(weight))
        out[k] += letter
        weight[k] += n
    return out


def signatures(words: DataFrame, parts: list[str]) -> DataFrame:
    """(key, word, n): the exact signatures of every word, among words of its
    length, as the shorter and as the longer word of a pair."""
    ordered = F.array_join(F.sort_array(F.split("word", "")), "")
    within = [F.translate(ordered, "".join(p for p in parts if p != own), "").alias(f"p{k}") for k, own in enumerate(parts)]
    length = F.char_length("word")

    def signed(kind: str, size: Column, chosen: list[list[int]]) -> list[Column]:
        one, two = F.floor(size / 3).cast("int"), F.floor(size * 2 / 3).cast("int")
        start = lambda n: F.substring("word", F.lit(1), n)
        end = lambda n: F.substring("word", length - n + 1, n)
        left = [[end(size - one)], [start(one), end(size - two)], [start(two)]]  # without the first, second, last third
        return [F.xxhash64(F.lit(f"{kind}{i}{k}"), size, *kept, *[F.col(f"p{p}") for p in of])
                for i, kept in enumerate(left) for k, of in enumerate(chosen)]

    same, apart = [[0], [1], [2]], [[0], [1, 2]]
    keys = F.array(*signed("s", length, same), *signed("d", length, apart), *signed("d", length - 1, apart))
    return words.select("word", "n", *within).select(F.explode(keys).alias("key"), "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): the words one edit away from each word that has any, as
    an array of (n, other).  A word of ``w`` letters has at most some 90
    (2 w + 1) of them, by the alphabet."""
    signed = signatures(words, letter_parts(words))
    a, b = signed.alias("a"), signed.alias("b")
    longer = F.expr("char_length(a.word) < char_length(b.word) or (char_length(a.word) = char_length(b.word) and a.word < b.word)")
    met = a.join(b, F.expr("a.key = b.key") & longer & (F.levenshtein("a.word", "b.word", 1) == 1)).select(
        F.inline(F.array(F.struct(F.col("a.word").alias("word"), F.struct(F.col("b.n").alias("n"), F.col("b.word").alias("other")).alias("near")),
                         F.struct(F.col("b.word").alias("word"), F.struct(F.col("a.n").alias("n"), F.col("a.word").alias("other")).alias("near")))))
    return met.groupBy("word").agg(F.collect_set("near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """``forms(word, form)`` -> (word, root): steps are doubled until none is
    left; a chain of n forms takes log2 n rounds."""
    has_form = forms.select(F.col("word").alias("w"))
    at = stage(forms.select("word", F.col("form").alias("at")).join(has_form, F.col("at") == F.col("w"), "left")
               .select("word", "at", F.col("w").isNotNull().alias("open")), "forms")
    while at.filter("open").head(1):
        beyond = at.select(F.col("word").alias("w"), F.col("at").alias("next"), F.col("open").alias("more"))
        ahead = at.filter("open").join(beyond, F.col("at") == F.col("w")).select(
            "word", F.col("next").alias("at"), F.col("more").alias("open"))
        at = stage(at.filter("not open").unionByName(ahead), "forms")
    return at.select("word", F.col("at").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = stage(vocabulary(docs), "vocabulary")
    best = F.array_min(F.transform("near", lambda x: F.struct((-x["n"]).alias("minus"), x["other"].alias("other"))))
    near = near_words(words).select("word", F.size("near").cast("long").alias("n_near"), best.alias("best"))
    known = F.col("best").isNotNull() & (-F.col("best.minus") >= RATIO * F.col("n"))
    told = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(known, F.col("best.other")).alias("form"),
        F.when(known, -F.col("best.minus")).cast("long").alias("form_n")), "variants")
    roots = _roots(told.filter("form is not null").select("word", "form"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
