"""Not-modified revisits of a crawl resolved to the responses they stand for.

A ``revisit`` record with the server-not-modified profile has no body: it says
that the page still is what an earlier response held.  It resolves to the
latest earlier full response (status 200) of the same canonical URL, provided
the validators agree: the entity tag if both sides have one (weak comparison:
a ``W/`` prefix does not count), else the modification date.  The resolved
record has the response's body and its headers, updated by those headers that a
304 may carry (``PERMITTED``).

The as-of join is a union of both kinds of records ordered by time, carrying
the last response forward.  A canonical URL may hold any share of the records,
so it is not one group: records are cut by (URL, slice of time), each group
carries forward within itself, and the few last responses of the slices are
carried from slice to slice.  Bodies stay out of it: only keys and validators
are ordered, the body is joined to a resolved record by all that names its
response: id, URL, time and validators.  The judged revisits are written once,
without bodies; a response that many of them name is then split over tasks, and
revisits that resolve to nothing stay out of that join.

Defined results: a null URL, time or id never resolves (``no-key``) and is no
candidate; of responses at the same time the largest id is the latest, and a
response at the revisit's own time is not earlier; responses that share an id
are told apart by URL, time and validators (of those alike in URL, time and id
the largest validators count, of those alike in these too the largest headers
and body), so a body always is that of the response whose validators were
compared; revisits that repeat are answered each; no earlier response is
``no-response``, disagreeing or missing validators are ``mismatch``; empty
tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from bookshift.llm.common import hot_keys, repeat_rows, split_rows, stage

#: Header fields that a 304 answer may update (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: seconds of a slice of time
SLICE = 7 * 24 * 3600


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``/``m.`` hosts, default ports, fragments, tracking
    parameters, upper-case hosts and final slashes do not tell pages apart."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"^(?i)https?://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(u, r"^([^/?]*)", 1), r"^(?i)(www|m)\.|:(80|443)$", ""))
    path = F.regexp_extract(u, r"^[^/?]*([^?]*)", 1)
    query = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"),
                                               lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)="))), "&")
    return F.concat(host, F.regexp_replace(path, r"/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(responses: DataFrame, revisits: DataFrame, slice_seconds: int = SLICE) -> DataFrame:
    """``responses(id, url, at, status, headers, body)`` and ``revisits(id,
    url, at, headers)``, headers as maps with lower-case names -> one row per
    revisit: id, url_key, response_id, outcome (resolved, mismatch,
    no-response, no-key), headers, body."""
    def keyed(df: DataFrame, *more: str) -> DataFrame:
        key = canonical_url(F.col("url"))
        return df.select("id", F.when(F.col("at").isNotNull() & F.col("id").isNotNull() & (key != ""), key).alias("key"),
                         "at", F.element_at("headers", "etag").alias("etag"),
                         F.element_at("headers", "last-modified").alias("modified"), "headers", *more)

    full = responses.filter("status = 200").withColumnRenamed("body", "full_body")
    known = keyed(full).filter("key is not null").select(
        "key", "at", F.lit(1).alias("side"), F.col("id").alias("rid"), F.struct(
            F.col("id").alias("rid"), F.col("etag").alias("retag"), F.col("modified").alias("rmodified"),
            F.col("at").alias("rat")).alias("last"),
        F.lit(None).cast("map<string,string>").alias("headers"), F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("modified"))
    asked = keyed(revisits)
    open_ = asked.filter("key is not null").select(
        "key", "at", F.lit(0).alias("side"), F.col("id").alias("rid"),
        F.lit(None).cast(known.schema["last"].dataType).alias("last"), "headers", "etag", "modified")
    # at one time revisits come before responses: a response at that time is not earlier
    both = open_.unionByName(known).withColumn("slice", F.floor(F.unix_timestamp("at") / slice_seconds))
    ends = (both.filter("side = 1").groupBy("key", "slice").agg(F.max(F.struct("at", "rid", "last"))["last"].alias("end"))
            .withColumn("next", F.lead("slice").over(W.partitionBy("key").orderBy("slice"))))
    within = W.partitionBy("key", "slice").orderBy("at", "side", "rid", "last")
    carried = both.withColumn("seen", F.last("last", ignorenulls=True).over(within)).filter("side = 0")
    here = carried.filter("seen is not null").select("key", "rid", "headers", "etag", "modified", "seen")
    # nothing earlier in its own slice: the end of the latest slice before
    waiting = carried.filter("seen is null")
    spans = ends.select(F.col("key").alias("k"), F.col("slice").alias("since"), F.col("next").alias("until"), "end")
    starts = waiting.select(F.col("key").alias("k"), "slice").distinct().join(spans, "k", "left").filter(
        "since is null or (since < slice and (until is null or until >= slice))").select(
        "k", F.col("slice").alias("s"), "end")
    later = waiting.join(starts, (F.col("key") == F.col("k")) & (F.col("slice") == F.col("s")), "left").select(
        "key", "rid", "headers", "etag", "modified", F.col("end").alias("seen"))
    none = asked.filter("key is null").select("key", F.col("id").alias("rid"), "headers", "etag", "modified",
                                              F.lit(None).cast(known.schema["last"].dataType).alias("seen"))
    by_tag = F.col("etag").isNotNull() & F.col("seen.retag").isNotNull()
    agree = F.when(by_tag, _weak(F.col("etag")) == _weak(F.col("seen.retag"))).otherwise(
        F.coalesce(F.col("modified") == F.col("seen.rmodified"), F.lit(False)))
    outcome = (F.when(F.col("key").isNull(), "no-key").when(F.col("seen").isNull(), "no-response")
               .when(agree, "resolved").otherwise("mismatch"))
    judged = stage(here.unionByName(later).unionByName(none).withColumn("outcome", outcome), "judged")
    found = judged.filter("outcome = 'resolved'").select("*", F.col("seen.rid").alias("sid"))
    # the response that gave the validators gives headers and body
    source = (keyed(full, "full_body").filter("key is not null")
              .groupBy(F.col("key").alias("skey"), F.col("id").alias("sid"), "at", "etag", "modified")
              .agg(F.max(F.struct(F.array_sort(F.map_entries("headers")).alias("entries"), "full_body")).alias("full"))
              .select("skey", "sid", F.col("at").alias("sat"), F.col("etag").alias("setag"),
                      F.col("modified").alias("smodified"), F.map_from_entries("full.entries").alias("old"), "full.full_body"))
    # a response that many revisits name is dealt out by revisit
    held = found.groupBy("sid").agg(F.count(F.lit(1)).alias("held"))
    hot = hot_keys(held, ["sid"], "held", judged.count())
    same = ((F.col("key") == F.col("skey")) & (F.col("seen.rat") == F.col("sat"))
            & F.col("seen.retag").eqNullSafe(F.col("setag")) & F.col("seen.rmodified").eqNullSafe(F.col("smodified")))
    left = split_rows(found, hot, ["sid"], ["rid"])
    right = repeat_rows(source, hot, ["sid"])
    both = left.join(right, (left["sid"] == right["sid"]) & (left["__share"] == right["__share"]) & same, "left")
    fresh = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("old", lambda k, _: ~F.map_contains_key(fresh, k)), fresh)
    resolved = both.select(F.col("rid").alias("id"), F.col("key").alias("url_key"), left["sid"].alias("response_id"), "outcome",
                           merged.alias("headers"), F.col("full_body").alias("body"))
    rest = judged.filter("outcome <> 'resolved'").select(
        F.col("rid").alias("id"), F.col("key").alias("url_key"), F.lit(None).cast(resolved.schema["response_id"].dataType).alias(
            "response_id"), "outcome", F.lit(None).cast("map<string,string>").alias("headers"),
        F.lit(None).cast("string").alias("body"))
    return resolved.unionByName(rest)


def crawl(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A crawl log over ``pages(page_id, url, html)``: every page is fetched in
    full once (``page_id`` times 4, times a few hours apart), and its address
    is asked for again three times, under other spellings of the URL: soon
    after, weeks later, and once with a tag that the server had changed."""
    day = F.col("page_id") % 97
    first = F.timestamp_seconds(F.lit(1700000000) + F.col("page_id") % 5000 * 60 + day * 86400)
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    changed = (F.lit(1690000000) + F.col("page_id") % 1000 * 3600).cast("string")
    stamp = lambda t: F.unix_timestamp(t).cast("string")  # noqa: E731 - the same text under any session time zone
    responses = pages.select(
        (F.col("page_id") * 4).alias("id"), "url", first.alias("at"),
        F.when(F.col("page_id") % 11 == 5, 404).otherwise(200).alias("status"),
        F.map_filter(F.create_map(
            F.lit("content-type"), F.lit("text/html"), F.lit("date"), stamp(first),
            F.lit("etag"), F.when(F.col("page_id") % 3 != 1, tag), F.lit("last-modified"), changed),
            lambda _, v: v.isNotNull()).alias("headers"), F.col("html").alias("body"))
    visit = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("visit")
    again = pages.select("page_id", "url", visit, tag.alias("tag"), changed.alias("changed"), first.alias("first"))
    at = F.timestamp_seconds(F.unix_timestamp("first") + F.when(F.col("visit") == 1, 3600).when(
        F.col("visit") == 2, 30 * 86400).otherwise(45 * 86400) - F.when(F.col("page_id") % 13 == 7, 50 * 86400).otherwise(0))
    revisits = again.select(
        (F.col("page_id") * 4 + F.col("visit")).alias("id"),
        F.when(F.col("visit") == 2, F.concat("url", F.lit("#again"))).otherwise(F.col("url")).alias("url"),
        at.alias("at"),
        F.map_filter(F.create_map(
            F.lit("date"), stamp(at), F.lit("server"), F.lit("edge"),
            F.lit("etag"), F.when(F.col("visit") == 3, F.lit('"changed"')).when(
                F.col("page_id") % 3 == 0, F.concat(F.lit("W/"), F.col("tag"))),
            F.lit("last-modified"), F.col("changed"), F.lit("cache-control"), F.concat(F.lit("max-age="), F.col("visit"))),
            lambda _, v: v.isNotNull()).alias("headers"))
    return responses, revisits


def digest(pages: DataFrame) -> DataFrame:
    """Columns of the registered query; -1 stands for no response."""
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")),
                                       lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return resolve(*crawl(pages)).select(
        "id", "url_key", F.coalesce("response_id", F.lit(-1)).alias("response_id"), "outcome", headers.alias("headers"),
        F.coalesce(F.char_length("body"), F.lit(-1)).cast("long").alias("body_chars"), F.md5("body").alias("body_md5"))
