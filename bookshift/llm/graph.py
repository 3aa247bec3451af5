"""Connected components of an edge table by alternating large and small stars.

Each round is two aggregations and joins on node ids; rounds grow with the
logarithm of the longest path.  The edges of a round are written to the shared
folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookshift.llm.common import SHARES, stage


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """``edges(u, v)`` with ``m``, the smallest node around ``u``.  Nodes that
    have more than one in ``SHARES`` of the edges (at most ``SHARES`` nodes) are
    looked up in a broadcast, and their edges dealt out by ``v``."""
    around = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("held"))
    hubs = around.filter(F.col("held") * SHARES > total).select("u", F.col("m").alias("hub"))
    marked = edges.join(F.broadcast(hubs), "u", "left").withColumn(
        "deal", F.when(F.col("hub").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("v"), F.lit(SHARES))).cast("long"))
    # a hub's own row has a deal that no edge has (and no constant, which would drop out of the join's keys)
    others = around.select("u", "m", F.when(F.col("held") * SHARES > total, F.lit(-1)).otherwise(0).cast("long").alias("deal"))
    met = marked.join(others, ["u", "deal"], "left")
    return met.select("u", "v", F.coalesce("hub", "m").alias("m"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every neighbour above ``u`` points to the smallest node around ``u``."""
    both = _with_least(edges.union(edges.select("v", "u")), 2 * total)
    return both.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every neighbour below ``u``, and ``u``, point to the smallest of them."""
    joined = _with_least(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), total)
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(joined.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs -> (node, label): every node that has an edge,
    with the smallest node of its component."""
    now = stage(edges.filter("u <> v").select("u", "v"), "edges")
    before, total = None, now.count()
    while total:
        now = stage(_small_star(_large_star(now, total), total), "stars")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == before:
            break
        before, total = mark, mark[0]
    tops = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        tops.select("node", F.col("node").alias("label")))
