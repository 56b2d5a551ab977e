"""License scan by diagonal voting, in DataFrame functions only.

All rolling word 3-grams of every text are hashed and joined to the positions of the
templates' 3-grams (the words are compared too).  A hit votes for the diagonal
``position in the text - position in the template``; votes are one bit a template
position, so a diagonal aggregates to one long.  Neighbouring diagonals (at most ``SLACK``
apart: words put in or left out) merge to one candidate span, which is verified by the
share of the template's 3-grams that it holds.  A base phrase stands at a place if its
diagonal has every bit.

Null text: like an empty one, no words.  Rows alike in id and text each get a result of
their own.  Very long texts: every word is rolled, a row a word.  Ties: labels are sets in
sorted order, places the smallest and largest, the score a maximum.  Empty table: empty
result.  Extra columns, of any name, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evwin.llm.common import row_key

GRAM = 3
#: Diagonals so far apart still belong to one span.
SLACK = 2
#: A span counts if it holds this share of its template's 3-grams.
SHARE = 0.8

# Phrases of the contract, and their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Opening or standing sentences of well-known notices, at most 64 words each.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under a creative commons attribution noncommercial", "cc-by-nc"),
    ("all rights reserved", "all-rights-reserved"),
]
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case.  lower() changes other letters too, which
    no template has; only the Kelvin sign would turn into an ASCII letter."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(low, _SEPARATORS, -1), "")


def _grams(ws: Column) -> Column:
    """One struct a word: it and the two words after it (null past the end)."""
    n = F.greatest(F.size(ws), F.lit(1))
    return F.arrays_zip(ws.alias("w0"), F.slice(ws, F.lit(2), n).alias("w1"), F.slice(ws, F.lit(3), n).alias("w2"))


def templates(spark, phrases: list[tuple[str, str]], base: bool) -> DataFrame:
    """A row for each 3-gram of each phrase; a fixed list, far below any broadcast limit."""
    if any(not GRAM <= len(p.split()) <= 64 for p, _ in phrases):
        raise ValueError("a template has 3 to 64 words")
    rows = [(i, label, base, len(p.split()) - GRAM + 1, tpos, *p.split()[tpos : tpos + GRAM]) for i, (p, label) in enumerate(phrases) for tpos in range(len(p.split()) - GRAM + 1)]
    return spark.createDataFrame(rows, "tid int, label string, base boolean, n_grams int, tpos int, t0 string, t1 string, t2 string")


def spans(docs: DataFrame, base: list[tuple[str, str]] = BASE, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """For each document (doc_id, rk, copies: rows alike, n_words) and template its merged
    spans: label, base, first and last (start of the span's first and last diagonal),
    share, n_exact (places where the whole template stands), exact_first, exact_last.
    A document without hits has one row with a null label."""
    spark = docs.sparkSession
    t = templates(spark, base, True).unionByName(templates(spark, [*notices], False).withColumn("tid", F.col("tid") + len(base))) if notices else templates(spark, base, True)
    t = t.withColumn("h", F.xxhash64("t0", "t1", "t2"))
    cut = docs.select("doc_id", row_key().alias("rk"), words(F.col("text")).alias("ws"))
    none = F.struct(*[F.lit(None).cast("string").alias(f"w{i}") for i in range(GRAM)])
    grams = F.concat(F.array(none), _grams(F.col("ws")))
    rolled = cut.select("doc_id", "rk", F.size("ws").cast("long").alias("n_words"), F.posexplode(grams).alias("pos", "g"))
    rolled = rolled.select("doc_id", "rk", "n_words", "pos", "g.*").withColumn("h", F.xxhash64("w0", "w1", "w2"))
    same = [rolled["h"] == t["h"], rolled["w0"] == t["t0"], rolled["w1"] == t["t1"], rolled["w2"] == t["t2"]]
    votes = rolled.join(F.broadcast(t), same, "left").filter((F.col("pos") == 0) | F.col("tid").isNotNull())
    doc = ["doc_id", "rk", "n_words"]
    diagonal = (F.col("pos") - 1 - F.col("tpos")).cast("long").alias("diagonal")
    counted = votes.groupBy(*doc, "tid", "label", "base", "n_grams", diagonal).agg(F.bit_or(F.expr("shiftleft(1L, tpos)")).alias("bits"), F.count(F.lit(1)).alias("rows"))
    of = Window.partitionBy(*doc, "tid")
    gap = F.col("diagonal") - F.lag("diagonal").over(of.orderBy("diagonal"))
    run = counted.withColumn("cut", F.when(gap <= SLACK, 0).otherwise(1)).withColumn("run", F.sum("cut").over(of.orderBy("diagonal")))
    whole = F.bit_count("bits") == F.col("n_grams")
    merged = run.groupBy(*doc, "tid", "label", "base", "n_grams", "run").agg(
        F.bit_or("bits").alias("bits"), F.max("rows").alias("copies"), F.min("diagonal").alias("first"), F.max("diagonal").alias("last"),
        F.sum(whole.cast("long")).alias("n_exact"), F.min(F.when(whole, F.col("diagonal"))).alias("exact_first"), F.max(F.when(whole, F.col("diagonal"))).alias("exact_last"))
    return merged.withColumn("share", F.bit_count("bits") / F.col("n_grams"))


def scan(docs: DataFrame, base: list[tuple[str, str]] = BASE, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (the largest share of a template that a span holds)."""
    found = F.col("base") & (F.col("n_exact") > 0)
    named = F.when(found | (F.col("share") >= SHARE) & ~F.col("base"), F.col("label"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  bounded by the templates
    out = spans(docs, base, notices).groupBy("doc_id", "rk", "n_words").agg(
        F.coalesce(F.sum(F.when(F.col("base"), F.col("n_exact"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(found, F.col("exact_first"))).alias("first_word"),
        F.max(F.when(found, F.col("exact_last"))).alias("last_word"),
        joined(F.when(found, F.col("label"))).alias("base_labels"),
        joined(named).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("tid").isNull(), F.col("copies"))).cast("int").alias("copies"))
    each = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
