"""License scans by diagonal voting, with DataFrame functions only.

Every rolling word gram of every text is joined, by a hash of its first two
words, to the positions where the license templates hold that gram. A hit votes
for the diagonal text position - template position: a template that stands in a
text puts all its grams on one diagonal, and words put in or left out move the
rest to a neighbouring one. Votes count only where the words themselves agree.
Diagonals at most ``DRIFT`` words apart are merged into a span, and a span is
verified: the template's grams found in it, over the grams that the longer of
span and template has, must reach ``COVER``. *Phrases* are templates that must
stand word by word: a single diagonal with all of its grams.

The templates are few and fixed, so they are the broadcast side. No text is
shuffled: hits are folded per row and diagonal before they leave their task, and
an edge mark behind the last word, which the template table knows, keeps rows
without any hit.

Nulls and the like: a null text is empty and has no words; null and repeated
ids are fine, for rows are told apart by a number of their own, so repeated rows
give repeated rows; several places that tie for a label count once in the labels
and each in the number of places; a very long text is one row of words, as long
as it fits one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Phrases that are looked for word by word.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# The words of public license notices, found with gaps.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

GRAM = 3  # words of a notice's gram; a phrase's has two
DRIFT = 4  # words between diagonals that are merged
COVER = 0.6  # of the longer of template and span
LONGEST = 64  # grams of a template: one bit each
EDGE = "\n"  # no word holds it


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per template: template (number), label, phrase, k (words of its
    grams), grams (how many it has) and its words w; the edge is number -1."""
    rows = [(-1, None, False, 2, [EDGE])]
    for n, (label, text) in enumerate((*phrases, *notices)):
        k = 2 if n < len(phrases) else GRAM
        if not k <= len(text.split()) < k + LONGEST:
            raise ValueError(f"a template must have {k} to {k + LONGEST - 1} words: {text}")
        rows.append((n, label, n < len(phrases), k, text.split()))
    names = ("template", "label", "phrase", "k")
    structs = [
        F.struct(
            *[F.lit(v).cast("string" if c == "label" else "boolean" if c == "phrase" else "int").alias(c) for c, v in zip(names, row[:4], strict=True)],
            F.array(*map(F.lit, row[4])).alias("w"),
        )
        for row in rows
    ]
    known = spark.range(1).select(F.inline(F.array(*structs)))
    return known.withColumn("grams", F.greatest(F.size("w") - F.col("k") + 1, F.lit(1)))


def template_grams(known: DataFrame) -> DataFrame:
    """One row per gram of a template: template, at, the gram's words t0 to t2
    (t2 null in a phrase) and ``key``, the hash to join on."""
    grams = known.select("template", "k", "grams", F.posexplode(grams_of("w")).alias("at", "g"))
    return grams.where("at < grams").select(
        "template",
        "at",
        F.col("g.w0").alias("t0"),
        F.col("g.w1").alias("t1"),
        F.when(F.col("k") > 2, F.col("g.w2")).alias("t2"),
        F.xxhash64("g.w0", "g.w1").alias("key"),
    )


def grams_of(words: str) -> Column:
    """The three words from every place on; null behind the last one."""
    size = F.size(words)
    return F.arrays_zip(
        F.col(words).alias("w0"),
        F.slice(words, F.lit(2), size).alias("w1"),
        F.slice(words, F.lit(3), size).alias("w2"),
    )


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case. The Kelvin sign, the one other letter
    whose lower case is plain ASCII, is put out of the way first."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(low, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def rolling_grams(docs: DataFrame) -> DataFrame:
    """row, doc_id, pos and the gram of three words there; the last gram of each
    row starts with the edge mark, at the number of words."""
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.concat(words_of(F.col("text")), F.array(F.lit(EDGE))).alias("w"),
    )
    return words.select("row", "doc_id", F.posexplode(grams_of("w")).alias("pos", "g")).select(
        "row", "doc_id", "pos", F.col("g.w0").alias("w0"), F.col("g.w1").alias("w1"), F.col("g.w2").alias("w2")
    )


def diagonals(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Votes per row, template and diagonal: ``bits`` has a bit for each gram of
    the template that was found there, lo and hi are its first and last place."""
    hits = rolling_grams(docs).withColumn("key", F.xxhash64("w0", "w1")).join(F.broadcast(grams), "key")
    same = (
        (F.col("w0") == F.col("t0"))
        & F.col("w1").eqNullSafe(F.col("t1"))
        & (F.col("t2").isNull() | (F.col("w2") == F.col("t2")))
    )
    edge = F.col("template") < 0
    vote = F.when(edge | F.coalesce(same, F.lit(False)), F.col("pos"))
    bit = F.expr("shiftleft(1L, at)")
    return (
        hits.groupBy("row", "doc_id", "template", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(
            F.bit_or(F.when(vote.isNotNull(), bit)).alias("bits"),
            F.min(vote).alias("lo"),
            F.max(vote).alias("hi"),
        )
        .where("bits is not null")
    )


def spans(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """row, doc_id, label, phrase, start, end (words, end exclusive) and score of
    each verified span, and per row one edge (label null, start = words)."""
    known = templates(docs.sparkSession, phrases, notices)
    votes = diagonals(docs, template_grams(known)).join(F.broadcast(known.drop("w")), "template")
    run = Window.partitionBy("row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(run)
    apart = F.when(step.isNull() | F.col("phrase") | (step > DRIFT), 1).otherwise(0)
    merged = (
        votes.withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(run))
        .groupBy("row", "doc_id", "template", "label", "phrase", "grams", "k", "span")
        .agg(F.bit_or("bits").alias("bits"), F.min("lo").alias("start"), F.max("hi").alias("hi"))
    )
    found, held = F.bit_count("bits"), F.col("hi") - F.col("start") + 1
    score = found / F.greatest(F.col("grams"), held)
    return (
        merged.withColumn("score", score)
        .where(F.col("score") >= F.when(F.col("phrase"), 1.0).otherwise(COVER))
        .select("row", "doc_id", "label", "phrase", "start", (F.col("hi") + F.col("k")).alias("end"), "score")
    )


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base (places of phrases),
    first_word, last_word (their least and greatest start), base_labels, labels
    (with those of notices), score (the best span's, 0 if there is none)."""
    edge, phrase = F.col("label").isNull(), F.col("label").isNotNull() & F.col("phrase")
    base = F.when(phrase, F.col("start").cast("long"))
    joined = lambda label: F.array_join(F.sort_array(F.collect_set(label)), ",")
    return (
        spans(docs, phrases, notices)
        .groupBy("row", "doc_id")
        .agg(
            F.max(F.when(edge, F.col("start").cast("long"))).alias("n_words"),
            F.count(base).alias("n_base"),
            F.min(base).alias("first_word"),
            F.max(base).alias("last_word"),
            joined(F.when(phrase, F.col("label"))).alias("base_labels"),
            joined(F.col("label")).alias("labels"),
            F.coalesce(F.max(F.when(~edge, F.col("score"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
