"""License scans with a positional rare-token index.

The words of a few licence notices and phrases form the vocabulary; the corpus
index holds their postings (see ``decontaminate.build_index``).  The licence
words of a notice (function words are none) are ranked by how many files hold
them.  A notice stands where enough of its licence words agree on where it
begins; of ``size`` words ``votes`` must agree, so one of any ``size - votes +
1`` does: only that many, those of highest IDF, are looked up.  Their places
in the files less their places in the notice propose where it may begin.  A
proposal counts only if the notice's mandatory key phrase stands at its place,
give or take ``SLACK`` words; then all its words vote, and the score is the
share that stands there.  No proposal is cut, for a file or for a notice.

DataFrame expressions only; the notices are a fixed, small table.

Defined results: null, empty and word-free texts give zeros, empty label
strings and null places; each input row counts as a file of its own, also
where ``doc_id`` is null or repeats; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from bookshift.llm.common import stage
from bookshift.llm.decontaminate import build_index

#: of the licence words of a notice so many must agree, and such a share
VOTES = 3
SHARE = 0.3
SLACK = 3
#: score of a file that has a base phrase but no notice
PHRASE_SCORE = 0.5

# Phrases that label a file wherever they stand.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

# Label, mandatory key phrase, notice.
NOTICES = [
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "the mit license", "released under the mit license"),
    ("apache", "the apache license", "licensed under the apache license version 2 0"),
    ("apache", "in compliance with the license",
     "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "gnu general public license",
     "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu general public license",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 3 of the license or at your option any later "
     "version"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("isc", "to use copy modify and or distribute this software",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "mozilla public license",
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa", "licensed under cc by sa 4 0"),
    ("unlicense", "unencumbered software released into the public domain",
     "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved", "copyright all rights reserved"),
]

# Words of the notices that are no licence words.
FUNCTION_WORDS = ("a all and any are as at at be by can for forms free from in into is it met not of on or out provided "
                  "that the this to under use v with without work you your may 0 2 3 4").split()


def rules() -> tuple[list[tuple], list[tuple]]:
    """(phrases, notices) as rows: (phrase, label or null, place, word) of base
    and key phrases; (notice, label, key phrase, key place, size, votes, place,
    word) of licence words."""
    keys = [k for _, k, _ in NOTICES]
    texts = [t for _, t in PHRASES]
    labels = {t: label for label, t in PHRASES}
    phrases = [(t, labels.get(t), j, w) for t in dict.fromkeys(texts + keys) for j, w in enumerate(t.split())]
    notices = []
    for n, (label, key, text) in enumerate(NOTICES):
        said, want = text.split(), key.split()
        place = next(i for i in range(len(said)) if said[i:i + len(want)] == want or i == len(said) - 1)
        if said[place:place + len(want)] != want:
            raise ValueError(f"the key phrase {key!r} is not in its notice")
        own = [(j, w) for j, w in enumerate(said) if w not in FUNCTION_WORDS]
        votes = max(min(VOTES, len(own)), math.ceil(SHARE * len(own)))
        notices += [(n, label, key, place, len(own), votes, j, w) for j, w in own]
    return phrases, notices


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table as a literal."""
    fields = [x.split() for x in schema.split(", ")]
    made = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(r, fields)]) for r in rows])
    return spark.range(1).select(F.inline(made))


def scan(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    phrase_rows, notice_rows = rules()
    said = [(k, text) for k, text in enumerate([t for _, t in PHRASES] + [k for _, k, _ in NOTICES]
                                               + [t for _, _, t in NOTICES])]
    index = build_index(docs, _rows(spark, said, "item_id long, text string"))
    terms = index.terms.select("term", "tid")
    phrases = F.broadcast(_rows(spark, phrase_rows, "phrase string, label string, j int, word string")
                          .join(terms, F.col("word") == F.col("term")).select("phrase", "label", "j", "tid"))
    notices = stage(_rows(spark, notice_rows, "notice int, label string, key string, key_at int, size int, votes int, j int, word string")
                    .join(terms, F.col("word") == F.col("term")).drop("word"), "notices")
    length = {t: len(t.split()) for t, *_ in phrase_rows}
    n_of = F.element_at(F.create_map(*[F.lit(x) for kv in length.items() for x in kv]), F.col("phrase"))

    places = stage(index.postings.join(phrases, "tid")
                   .groupBy("rid", "phrase", "label", (F.col("pos") - F.col("j")).alias("at"))
                   .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == n_of).drop("n"), "phrases")
    base = (places.filter("label is not null").groupBy("rid")
            .agg(F.count(F.lit(1)).alias("n_base"), F.min("at").cast("long").alias("first_word"),
                 F.max("at").cast("long").alias("last_word"), F.sort_array(F.collect_set("label")).alias("base")))

    licence = F.broadcast(notices.select("tid", "term").distinct())
    held = stage(index.postings.join(licence, "tid").select("rid", "pos", "tid", "term"), "licence-words")
    files = held.select("tid", "rid").distinct().groupBy("tid").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(W.partitionBy("notice").orderBy(F.coalesce("df", F.lit(0)), "term", "j"))
    rare = F.broadcast(notices.join(files, "tid", "left").withColumn("rank", rank)
                       .filter(F.col("rank") <= F.col("size") - F.col("votes") + 1).select("notice", "j", "tid"))
    align = ["rid", "notice", "at"]
    proposed = (held.join(rare, "tid").select("rid", "notice", (F.col("pos") - F.col("j")).alias("at")).distinct()
                .join(F.broadcast(notices.select("notice", "label", "key", "key_at", "size", "votes").distinct()), "notice"))
    keys = places.select(F.col("rid").alias("key_rid"), "phrase", F.col("at").alias("key_pos"))
    keyed = proposed.join(keys, (F.col("rid") == F.col("key_rid")) & (F.col("key") == F.col("phrase"))
                          & (F.abs(F.col("at") + F.col("key_at") - F.col("key_pos")) <= SLACK), "left_semi")
    likely = stage(keyed.select(*align, "label", "size", "votes"), "likely")
    words_there = held.join(F.broadcast(notices.select("notice", "j", "tid")), "tid")
    found = (words_there.join(likely.select("rid").distinct(), "rid", "left_semi")
             .groupBy("rid", "notice", (F.col("pos") - F.col("j")).alias("at"))
             .agg(F.count(F.lit(1)).alias("stand")).join(likely, align).filter("stand >= votes")
             .groupBy("rid").agg(F.max(F.col("stand") / F.col("size")).alias("cover"),
                                 F.collect_set("label").alias("added")))
    none = F.array().cast("array<string>")
    return (index.postings.filter("tid = 0").select("rid", "doc_id", F.col("pos").cast("long").alias("n_words"))
            .join(base, "rid", "left").join(found, "rid", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                    "first_word", "last_word",
                    F.array_join(F.coalesce("base", none), ",").alias("base_labels"),
                    F.array_join(F.sort_array(F.array_union(F.coalesce("base", none), F.coalesce("added", none))), ",")
                    .alias("labels"),
                    F.coalesce("cover", F.when(F.col("n_base") > 0, F.lit(PHRASE_SCORE)), F.lit(0.0)).alias("score")))
