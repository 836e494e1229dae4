"""License scans by diagonal voting.

Method. Every position of a text's words gives the hash of the word pair
that starts there. Spark joins these to the positions of the templates'
pairs (a small table of stated size, broadcast); a match counts where the
words of the whole k-gram agree at both places. Whether a phrase stands
there word for word is told in the same projection, so the rows that are
shuffled hold numbers only and their cost is linear in the matches. Each
match votes for a diagonal, its word position in the text less its position in the
template. Votes are summed per text, template and diagonal, neighbouring
diagonals within ``SLACK`` words are merged, and a merged span is kept when
its words verify: an exact phrase must be there word for word, a longer
template must have at least ``MIN_COVER`` of its k-gram positions matched
word for word, in its own order.

Edge cases. A null text is empty: no words, no labels, score 0. Every row
gives one row, repeated rows too. A text may hold a phrase many times; all
places count. Empty input gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeward.llm.common import table, take

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLACK = 2
MIN_COVER = 0.8

#: Base phrases and their labels (fixed values).
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Further license notices, in their usual wording, and their labels.
NOTICES = (
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


#: Versions, where one word makes the difference: matched word for word.
VERSIONS = (
    ("general public license version 3", "gpl-3.0"),
    ("general public license version 2", "gpl-2.0"),
    ("general public license v3", "gpl-3.0"),
    ("general public license v2", "gpl-2.0"),
)


def templates(base=BASE, notices=NOTICES, versions=VERSIONS) -> list[dict]:
    """One row per template and k-gram position. Base phrases and versions
    are matched whole (k = 2 at each pair); notices take k = 3."""
    rows = []
    for number, (phrase, label) in enumerate([*base, *versions, *notices]):
        words = phrase.split()
        exact = number < len(base) + len(versions)
        k = 2 if exact else 3
        for at in range(len(words) - k + 1):
            rows.append({"template": number, "label": label, "is_base": number < len(base), "exact": exact, "size": len(words), "grams": len(words) - k + 1,
                         "k": k, "at": at, "first": words[at], "second": words[at + 1], "rest": words[at + 2:at + k], "words": words})
    return rows


TEMPLATE_SCHEMA = ("template int, label string, is_base boolean, is_exact boolean, size int, grams int, k int, at int, first string, "
                   "second string, rest array<string>, words array<string>")


def _word(words: Column, at: Column) -> Column:
    return F.get(words, at)


def license_spans(docs: DataFrame, rows: list[dict] | None = None) -> DataFrame:
    """One row per document and verified span, and one with a null template
    for each document: uid, doc_id, n_words, template, label, is_base,
    start, end (word positions), cover.

    The template table is a parameter of the call and is broadcast; it has
    at most as many rows as it has words."""
    spark = docs.sparkSession
    rows = templates() if rows is None else rows
    grams = spark.createDataFrame([tuple(r.values()) for r in rows], TEMPLATE_SCHEMA)
    grams = grams.select(F.xxhash64("first", "second").alias("t_hash"), "template", F.col("at").alias("t_at"),
                         F.concat(F.array("first", "second"), "rest").alias("t_gram"), "k", "size", "words")
    d = take(docs, "doc_id", "text").select(
        "doc_id", F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), CAPITALS, SMALL), F.lit(WORD), F.lit(0)).alias("doc_words"))
    d = d.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "doc_words", F.size("doc_words").alias("n_words"))
    # position -1 stands for the document itself
    at = d.withColumn("pos", F.explode(F.sequence(F.lit(-1), F.greatest(F.col("n_words") - 2, F.lit(-1)), F.lit(1))))
    words, pos = F.col("doc_words"), F.col("pos")
    at = at.withColumn("gram", F.when(pos >= 0, F.xxhash64(_word(words, pos), _word(words, pos + 1))))
    hits = at.join(F.broadcast(grams), (F.col("gram") == F.col("t_hash"))
                   & (F.slice(words, F.greatest(pos, F.lit(0)) + 1, F.col("k")) == F.col("t_gram")), "left")
    hits = hits.filter((pos < 0) | F.col("template").isNotNull())
    hits = hits.withColumn("start", pos - F.col("t_at"))
    inside = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words"))
    exact = F.when(inside & (F.col("t_at") == 0), F.slice(words, F.greatest(F.col("start"), F.lit(0)) + 1, F.col("size")) == F.col("words"))
    # from here on without the text's words
    hits = hits.select("uid", "doc_id", "n_words", "template", "start", "t_at", exact.alias("exact"))
    votes = hits.groupBy("uid", "doc_id", "n_words", "template", "start").agg(
        F.count(F.lit(1)).alias("votes"), F.min("t_at").alias("t_lo"), F.max("t_at").alias("t_hi"),
        F.max("exact").alias("exact"), F.collect_set("t_at").alias("t_ats"))
    # neighbouring diagonals of a template are one span
    order = W.partitionBy("uid", "template").orderBy("start")
    new = F.coalesce(F.col("start") - F.lag("start").over(order) > SLACK, F.lit(True)) | F.col("is_exact")
    kinds = spark.createDataFrame([(r["template"], r["label"], r["is_base"], r["exact"], r["size"], r["grams"]) for r in rows if r["at"] == 0],
                                  "template int, label string, is_base boolean, is_exact boolean, size int, grams int")
    votes = votes.join(F.broadcast(kinds), "template", "left")
    votes = votes.withColumn("span", F.sum(new.cast("int")).over(order))
    merged = votes.groupBy("uid", "doc_id", "n_words", "template", "label", "is_base", "is_exact", "size", "grams", "span").agg(
        F.min(F.col("start") + F.col("t_lo")).alias("from"), F.max(F.col("start") + F.col("t_hi")).alias("to"),
        F.min("start").alias("start"), F.max("exact").alias("exact"),
        F.size(F.array_distinct(F.flatten(F.collect_list("t_ats")))).alias("covered"))
    cover = F.col("covered") / F.col("grams")
    good = F.col("template").isNull() | F.when(F.col("is_exact"), F.coalesce("exact", F.lit(False))).otherwise(cover >= MIN_COVER)
    merged = merged.withColumn("cover", cover).filter(good)
    return merged.select("uid", "doc_id", "n_words", "template", "label", "is_base",
                         F.when(F.col("is_exact"), F.col("start")).otherwise(F.col("from")).alias("start"),
                         F.when(F.col("is_exact"), F.col("start") + F.col("size")).otherwise(F.least(F.col("to") + 3, F.col("n_words"))).alias("end"),
                         F.when(F.col("template").isNotNull(), F.when(F.col("is_exact"), 1.0).otherwise(cover)).alias("cover"))


def license_report(docs: DataFrame, rows: list[dict] | None = None) -> DataFrame:
    """One row per document: what license_spans finds, summed up."""
    spans = license_spans(docs, rows)
    base = F.col("is_base")
    of = spans.groupBy("uid", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.count("template").alias("n_spans"))
    return of.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_base").cast("long").alias("n_base"),
                     "first_word", "last_word", "base_labels", "labels", F.col("score").cast("double").alias("score"), "n_spans")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))
