"""Benchmark decontamination over a distributed positional inverted index.

Index: one posting (term, document, position) for every training word that is
a benchmark term, written once, each file sorted by term, document and
position.  A posting of the empty term at the end of a document holds its
length.  The index is dealt out by document, so a frequent term is spread over
all files instead of filling one list.

Exact phrases: each window of ``width`` consecutive item words (a shorter
item is one window) is looked up by its ``ANCHORS`` rarest terms; their lists,
with positions moved back by the term's place in the item, intersect in the
places where the window may stand.  Only there the lists of its other terms
are intersected too, which proves the phrase word by word.

Proximity: the ``ANCHORS + 1`` rarest distinct terms of an item within
``span`` consecutive words, in any order.

DataFrame expressions only.  Benchmark-sized tables are broadcast up to a
checked size and shuffled beyond it; nothing of the corpus reaches the driver.

Defined results: null, empty and word-free texts have no words, never match
and are reported with zeros; each input row counts as a document of its own,
also where ``doc_id`` repeats or is null; item rows with the same ``item_id``
count as one item; an empty benchmark gives zeros for every document, an empty
corpus no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from bookshift.llm.common import broadcast_up_to, stage, words

WIDTH = 13
ANCHORS = 3
SPAN = 32
#: contaminated if at least one word in so many is hit
ONE_IN = 20


class Index(NamedTuple):
    postings: DataFrame  # rid, doc_id, tid, pos, said; tid 0 marks the end of a document and has its text's hash
    terms: DataFrame     # term, tid, held (postings of the term)
    items: DataFrame     # bid, item_id, w (words)


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    return broadcast_up_to(df, df.count(), row_bytes)


def _print(text: Column) -> Column:
    """64 bits that tell the texts of one ``doc_id`` apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def build_index(docs: DataFrame, benchmark: DataFrame) -> Index:
    """Index the corpus words that occur in the benchmark."""
    items = stage(benchmark.select("item_id", words(F.col("text").cast("string")).alias("w")).filter("size(w) > 0")
                  .withColumn("bid", F.monotonically_increasing_id()), "items")
    vocabulary = stage(items.select(F.explode("w").alias("term")).distinct()
                       .withColumn("tid", F.monotonically_increasing_id() + 1), "terms")
    spark = docs.sparkSession
    listed = vocabulary.unionByName(spark.range(1).select(F.lit("").alias("term"), F.lit(0).cast("long").alias("tid")))
    said = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text").cast("string")).alias("w"),
                        _print(F.col("text")).alias("said"))
            .withColumn("rid", F.monotonically_increasing_id())
            .select("rid", "doc_id", "said", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "term")))
    postings = stage(said.join(_small(listed, 64), "term")
                     .select("tid", "rid", "pos", "doc_id", F.when(F.col("tid") == 0, F.col("said")).alias("said"))
                     .sortWithinPartitions("tid", "rid", "pos"), "postings")
    held = postings.groupBy("tid").agg(F.count(F.lit(1)).alias("held"))
    terms = stage(vocabulary.join(held, "tid", "left").select("term", "tid", F.coalesce("held", F.lit(0)).alias("held")),
                  "frequencies")
    return Index(postings, terms, items)


def _item_terms(index: Index) -> DataFrame:
    """bid, item_id, terms: array of (j, tid, held, term) in item order."""
    spelled = index.items.select("bid", "item_id", F.posexplode("w").alias("j", "term")).join(index.terms, "term")
    return spelled.groupBy("bid", "item_id").agg(F.sort_array(F.collect_list(F.struct("j", "tid", "held", "term"))).alias("terms"))


def phrase_matches(index: Index, width: int = WIDTH) -> DataFrame:
    """(rid, bid, item_id, start, end): every occurrence of a window, as word
    positions of the document, end exclusive."""
    last = F.greatest(F.size("terms") - width, F.lit(0))
    window = F.transform(F.sequence(F.lit(0), last), lambda s: F.slice("terms", s + 1, F.lit(width)))
    possible = F.filter(window, lambda t: ~F.exists(t, lambda x: x["held"] == 0))

    def rarest(t):
        order = F.array_sort(F.transform(t, lambda x: F.struct(x["held"], x["j"], x["tid"])))
        return F.struct(t[0]["j"].alias("s"), F.size(t).alias("n"),
                        F.slice(F.transform(order, lambda x: x["j"]), 1, ANCHORS).alias("anchors"))

    items = stage(_item_terms(index).select("bid", "item_id", F.transform("terms", lambda x: x["tid"]).alias("tids"),
                                            F.transform(possible, rarest).alias("windows")).filter("size(windows) > 0"),
                  "windows")
    probes = items.select("bid", "tids", F.explode(F.array_distinct(F.flatten(F.transform(
        "windows", lambda x: x["anchors"])))).alias("j")).select("bid", "j", F.expr("tids[j]").alias("tid"))
    n_items = items.count()
    looked = (index.postings.join(_small(stage(probes, "probes"), 32), "tid")
              .select("rid", "bid", (F.col("pos") - F.col("j")).alias("at"), "j")
              .groupBy("rid", "bid", "at").agg(F.collect_set("j").alias("js")))
    likely = stage(looked.join(broadcast_up_to(items, n_items, 2048), "bid")
                   .select("rid", "bid", "at", F.expr("filter(windows, x -> size(array_except(x.anchors, js)) = 0)")
                           .alias("windows"), "tids").filter("size(windows) > 0")
                   .select("rid", "bid", "at", "windows", F.explode(F.array_distinct(F.flatten(F.transform(
                       "windows", lambda x: F.sequence(x["s"], x["s"] + x["n"] - 1))))).alias("j"), "tids")
                   .select("rid", "bid", "at", "windows", "j", (F.col("at") + F.col("j")).alias("pos"),
                           F.expr("tids[j]").alias("tid")), "likely")
    wanted = likely.select("rid", "tid", "pos", "bid", "at", "j")
    rids = likely.select("rid").distinct()
    near = index.postings.join(broadcast_up_to(rids, rids.count(), 16), "rid", "left_semi")
    proven = (near.select("rid", "tid", "pos").join(broadcast_up_to(wanted, wanted.count(), 48), ["rid", "tid", "pos"])
              .groupBy("rid", "bid", "at").agg(F.collect_set("j").alias("js")))
    stood = (likely.select("rid", "bid", "at", "windows").dropDuplicates(["rid", "bid", "at"])
             .join(proven, ["rid", "bid", "at"])
             .select("rid", "bid", "at", F.explode(F.expr(
                 "filter(windows, x -> size(array_except(sequence(x.s, x.s + x.n - 1), js)) = 0)")).alias("x"))
             .select("rid", "bid", (F.col("at") + F.col("x.s")).alias("start"),
                     (F.col("at") + F.col("x.s") + F.col("x.n")).alias("end")))
    return stood.join(broadcast_up_to(items.select("bid", "item_id"), n_items, 32), "bid")


def proximity_matches(index: Index, span: int = SPAN) -> DataFrame:
    """(rid, bid, item_id, n): places where the rarest terms of an item all
    stand within ``span`` consecutive words."""
    distinct = F.array_sort(F.array_distinct(F.transform("terms", lambda x: F.struct(x["held"], x["term"], x["tid"]))))
    rare = _item_terms(index).select("bid", "item_id", F.slice(distinct, 1, ANCHORS + 1).alias("rare")).filter(
        ~F.exists("rare", lambda x: x["held"] == 0))
    probes = stage(rare.select("bid", "item_id", F.size("rare").alias("needed"), F.explode("rare").alias("x"))
                   .select("bid", "item_id", "needed", F.col("x.tid").alias("tid")), "rare")
    back = W.partitionBy("rid", "bid").orderBy("pos").rangeBetween(1 - span, 0)
    return (index.postings.join(_small(probes, 48), "tid")
            .withColumn("seen", F.size(F.collect_set("tid").over(back))).filter("seen = needed")
            .groupBy("rid", "bid", "item_id").agg(F.count(F.lit(1)).alias("n")))


def _covered(spans):
    """Words covered by sorted [start, end) spans."""
    return F.aggregate(spans, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), lambda acc, x: F.struct(
        F.greatest(acc["upto"], x["end"]).alias("upto"),
        (acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["upto"]), F.lit(0))).alias("n")))["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit (words inside an
    occurrence of a window), n_items, items_sha256, contaminated, n_near
    (items in proximity)."""
    return _judged(docs, benchmark, width).drop("said")


def _judged(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    index = build_index(docs, benchmark)
    hits = (phrase_matches(index, width).groupBy("rid")
            .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"),
                 F.sort_array(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("ids"))
            .select("rid", _covered("spans").alias("hit"), "ids"))
    near = proximity_matches(index).groupBy("rid").agg(
        F.count_distinct(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("near"))
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return (index.postings.filter("tid = 0").select("rid", "doc_id", "said", F.col("pos").cast("long").alias("n_words"))
            .join(hits, "rid", "left").join(near, "rid", "left")
            .select("doc_id", "said", "n_words", n_hit.alias("n_hit"),
                    F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
                    ((n_hit > 0) & (ONE_IN * n_hit >= F.col("n_words"))).alias("contaminated"),
                    F.coalesce("near", F.lit(0)).cast("long").alias("n_near")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents, all columns kept.  Rows go by
    ``doc_id`` and text: a clean row that shares the ``doc_id`` of a
    contaminated one, or has none either, stays."""
    gone = stage(_judged(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("__id"), F.col("said").alias("__said"))
                 .distinct(), "contaminated")
    return docs.join(_small(gone, 24), docs["doc_id"].eqNullSafe(gone["__id"]) & (_print(docs["text"]) == gone["__said"]), "left_anti")
