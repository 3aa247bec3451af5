"""Filter interaction audit: what each filter of a chain adds, in every order.

1. One pass over the texts gives each row the filters it fails by itself, as
   bits, and a 64-bit hash of its text.
2. Filter E (an identical text has a smaller ``doc_id``) is an existential
   self-join: rows whose hash stands under several ids are read again and
   left-semi joined on hash, exact text and a smaller id.  The other side of
   the join holds a text once, with its smallest id (any row that finds a
   smaller id finds this one), so copies are never paired with copies; a text
   that holds a large share of the rows is split into shares on both sides.
3. The ids that fail E are united with the ids and bits of step 1; one
   aggregate ors the bits of a document, and the documents are counted by
   part, bit combination and labels: at most 128 counts a part.
4. Those counts alone give every order and step: what is kept, removed,
   redundant or lost is a sum over bit combinations.

Defined results: null text is empty (it fails A); a null ``doc_id`` is neither
smaller nor larger than another, so its row never fails E and makes none fail;
rows that share a ``doc_id`` are documents of their own, and none is smaller
than the other; null ``lang`` is the part with an empty name; a label counts
where any row of its ``doc_id`` has it; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from bookshift.llm.common import blank_words, broadcast_up_to, hot_keys, repeat_rows, split_rows, stage

FILTERS = "ABCDE"
MIN_WORDS = 200
#: filter B: fewer distinct words than so many in a hundred
DISTINCT_PERCENT = 50
#: filter C: more capitals than so many in a hundred characters
CAPITAL_PERCENT = 3
MARKS = r"[#$%&*|]"


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def own_failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, hash, bits): the filters each row fails by its own text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    told = texts.select("doc_id", "part", F.xxhash64("text").alias("hash"), blank_words(text).alias("w"),
                        F.regexp_count(text, F.lit("[A-Z]")).alias("capitals"),
                        F.char_length(text).alias("chars"), text.rlike(MARKS).alias("marked"))
    n = F.size("w")
    fails = {"A": n < MIN_WORDS, "B": 100 * F.size(F.array_distinct("w")) < DISTINCT_PERCENT * n,
             "C": 100 * F.col("capitals").cast("long") > CAPITAL_PERCENT * F.col("chars").cast("long"), "D": F.col("marked")}
    bits = sum((F.when(test, _bit(name)).otherwise(0) for name, test in fails.items()), F.lit(0))
    return told.select("doc_id", "part", "hash", bits.alias("bits"))


def later_copies(docs: DataFrame, facts: DataFrame) -> DataFrame:
    """(doc_id, part, hash) of the rows that fail E; ``facts`` as
    :func:`own_failures` gives them."""
    held = stage(facts.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("z"))
                 .filter("a < z").select("hash", "n"), "copies")
    total, suspects = held.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    hot = hot_keys(held, ["hash"], "n", total)
    named = broadcast_up_to(held.select("hash"), suspects, 8)
    again = texts.filter("doc_id is not null").join(named, "hash", "left_semi")
    first = again.groupBy("hash", "text").agg(F.min("doc_id").alias("first_id"))
    many = split_rows(again, hot, ["hash"], ["doc_id"]).alias("x")
    once = repeat_rows(first, hot, ["hash"]).alias("y")
    return many.join(once, F.expr("x.hash = y.hash and x.__share = y.__share and x.text = y.text and y.first_id < x.doc_id"),
                     "left_semi").select("doc_id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): documents by the letters of the filters
    they fail and by label."""
    facts = stage(own_failures(docs), "failures")
    failing = facts.withColumn("n", F.lit(1)).unionByName(
        later_copies(docs, facts).select("*", F.lit(_bit("E")).alias("bits"), F.lit(0).alias("n")))
    judged = (failing.groupBy("doc_id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
              .groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n")))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
                           F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
             .filter("doc_id is not null and (good or toxic)")
             .groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    has = lambda name: F.coalesce(F.col(name), F.lit(False)).alias(name)
    fails = F.concat(*[F.when(F.col("bits").bitwiseAND(_bit(x)) > 0, x).otherwise("") for x in FILTERS])
    return (judged.join(known, "doc_id", "left").select("part", fails.alias("fails"), has("good"), has("toxic"), "n")
            .groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley."""
    counted = stage(combinations(docs, labels), "combinations")
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    steps = (counted.withColumn("filter_order", F.explode(orders))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
             .withColumn("letter", F.expr("substring(filter_order, step, 1)"))
             .withColumn("before", F.expr("substring(filter_order, 1, step - 1)")))
    gone = F.expr("length(translate(before, fails, '')) < step - 1")
    failing = F.expr("contains(fails, letter)")
    of = lambda test, name: F.sum(F.when(test, F.col("n")).otherwise(0)).cast("long").alias(name)
    told = steps.groupBy("part", "filter_order", "step", "letter").agg(
        of(~gone & ~failing, "kept"), of(~gone & failing, "removed"), of(gone & failing, "redundant"),
        of(F.col("fails") == F.col("letter"), "unique_fails"), of(~gone & failing & F.col("good"), "good_lost"),
        of(~gone & failing & F.col("toxic"), "toxic_lost"))
    of_filter = W.partitionBy("part", "letter")  # one row an order
    return told.withColumn("shapley", F.sum("removed").over(of_filter).cast("long")).drop("letter")
