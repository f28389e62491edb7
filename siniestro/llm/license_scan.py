"""Operator 4: license scan by diagonal voting.

DataFrame functions only.

1. Templates (the base phrases and passages of well-known licenses) become a
   small table of word 2-grams with their position; the texts are fixed values
   of this file, so the table is broadcast whatever the corpus.
2. Every text is split into words and all its rolling 2-grams are joined to
   the template positions by hash, and the words themselves are compared.
3. Matches vote for their diagonal (position in the text minus position in
   the template).  A base phrase stands exactly where a diagonal has a vote
   for each of its 2-grams; the diagonal is its first word.
4. For license passages, neighbouring diagonals (words put in or left out
   shift the rest of a passage) merge; the merged span is verified: the
   distinct 2-grams of the template it covers must be at least ``COVERAGE`` of
   all, within at most twice the template's length.  Stray votes can chain
   onto a passage's own; a run that gets too long by that is looked at in
   windows of diagonals, one from each of its diagonals on and as wide as a
   span of that length allows, and the best window of each place is verified.

Template places are bits of as many 64-bit masks as the longest template
needs, so a template may be a whole license text.

2-grams of two function words get no vote in a license passage (they stand
everywhere); the base phrases vote with every 2-gram.

Only matches are shuffled, by document.

Defined results: null and empty texts have no words; no place gives null for
first and last word, empty label strings and score 0; a base place scores 1,
else the best verified coverage counts; a null ``doc_id`` is kept as null;
rows that repeat a ``doc_id`` are scanned each; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siniestro.llm.columns import doc_key, lower_ascii, text_or_empty, text_version
from siniestro.session import materialize

# The base phrases and their labels, as the contract has them.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Passages of well-known public licenses (words in lower case).
PASSAGES = {
    "apache-2.0": "licensed under the apache license version 2 0 the license you may not use this file except in "
                  "compliance with the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
           "that the following conditions are met",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
           "hereby granted",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
           "associated documentation files to deal in the software without restriction",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files the software to deal in the software without restriction including "
                "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                "the following conditions the above copyright notice and this permission notice shall be included in "
                "all copies or substantial portions of the software the software is provided as is without warranty "
                "of any kind express or implied including but not limited to the warranties of merchantability "
                "fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
                "holders be liable for any claim damages or other liability whether in an action of contract tort or "
                "otherwise arising from out of or in connection with the software or the use or other dealings in "
                "the software",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
# Words that don't tell one passage from another.
FUNCTION_WORDS = frozenset("a and any are as by for in is it of or that the this to under with you".split())

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVERAGE = 0.8
SHIFT = 3


def templates(passages: dict[str, str] = PASSAGES) -> list[tuple]:
    """(template, label, base, at, a, b, n, length): one per voting 2-gram; n: how many of these."""
    rows = []
    texts = [(True, text, label) for text, label in BASE.items()]
    texts += [(False, text, label) for label, text in passages.items()]
    for number, (base, text, label) in enumerate(texts):
        words = text.split()
        grams = [(i, a, b) for i, (a, b) in enumerate(zip(words, words[1:], strict=False))
                 if base or not FUNCTION_WORDS.issuperset((a, b))]
        if not grams:
            raise ValueError(f"a template has two words or more, not function words alone: {text!r}")
        rows += [(number, label, base, i, a, b, len(grams), len(words)) for i, a, b in grams]
    return rows


def template_table(spark: SparkSession, passages: dict[str, str] = PASSAGES) -> DataFrame:
    """:func:`templates` as a table."""
    values = ", ".join(f"({t}, '{label}', {str(base).lower()}, {i}, '{a}', '{b}', {n}, {size})"
                       for t, label, base, i, a, b, n, size in templates(passages))
    return spark.sql(f"select * from values {values} as t(template, label, base, at, a, b, n, length)")


def masks_of(passages: dict[str, str] = PASSAGES) -> list[str]:
    """Names of the mask columns: one for each 64 places of the longest template."""
    return [f"votes{k}" for k in range(max(row[3] for row in templates(passages)) // 64 + 1)]


def words_of(docs: DataFrame) -> DataFrame:
    """(id, version, words) of whole texts."""
    return docs.select(
        doc_key().alias("id"), text_version().alias("version"),
        F.filter(F.split(lower_ascii(text_or_empty()), WORD_GAP), lambda w: w != "").alias("words"))


def matches(docs: DataFrame, passages: dict[str, str] = PASSAGES) -> DataFrame:
    """Every 2-gram of every text that some template has, with its place and the template's."""
    zipped = words_of(docs).select("id", "version", F.arrays_zip(
        F.col("words").alias("a"), F.slice("words", 2, F.size("words")).alias("b")).alias("grams"))
    grams = zipped.select("id", "version", F.posexplode("grams").alias("pos", "g")) \
        .select("id", "version", "pos", F.col("g.a").alias("a"), F.col("g.b").alias("b")) \
        .filter(F.col("b").isNotNull()).withColumn("h", F.xxhash64("a", "b"))
    table = template_table(docs.sparkSession, passages).withColumn("h", F.xxhash64("a", "b"))
    return grams.join(F.broadcast(table), ["h", "a", "b"]).drop("h", "a", "b")


def diagonals(found: DataFrame, masks: list[str]) -> DataFrame:
    """Votes per document, template and diagonal: the template places seen as bit masks, and the text places."""
    bits = [F.expr(f"bit_or(case when at div 64 = {k} then shiftleft(1L, at % 64) else 0L end)").alias(name)
            for k, name in enumerate(masks)]
    return (found.withColumn("diagonal", F.col("pos") - F.col("at"))
            .groupBy("id", "version", "template", "label", "base", "n", "length", "diagonal")
            .agg(*bits, F.min("pos").alias("low"), (F.max("pos") + 1).alias("high")))


def spans(votes: DataFrame, masks: list[str], longest: int, coverage: float = COVERAGE,
          shift: int = SHIFT) -> DataFrame:
    """Verified spans: (id, version, label, base, first, last, coverage), words first to last.

    ``longest``: the words of the longest template.
    """
    seen = reduce(lambda a, b: a + b, [F.bit_count(name) for name in masks])
    share = seen / F.col("n")
    out = ("id", "version", "label", "base", "first", "last", "coverage")
    exact = votes.filter(F.col("base") & (seen == F.col("n"))).select(
        "id", "version", "label", "base", F.col("diagonal").alias("first"),
        (F.col("diagonal") + F.col("length") - 1).alias("last"), F.lit(1.0).alias("coverage"))
    by_template = Window.partitionBy("id", "version", "template").orderBy("diagonal")
    near = votes.filter("not base").withColumn(
        "new", F.when(F.col("diagonal") - F.lag("diagonal").over(by_template) <= shift, 0).otherwise(1)) \
        .withColumn("run", F.sum("new").over(by_template))
    whole = Window.partitionBy("id", "version", "template", "run")
    runs = near.withColumn("first", F.min("low").over(whole)).withColumn("last", F.max("high").over(whole))
    fits = F.col("last") - F.col("first") < 2 * F.col("length")
    merged = (runs.filter(fits).groupBy("id", "version", "template", "label", "base", "n", "length", "run", "first", "last")
              .agg(*(F.expr(f"bit_or({name})").alias(name) for name in masks)).withColumn("coverage", share))
    # Diagonals in steps of about unit / length, so that one frame is length - 1 further diagonals for a template of
    # any length; the places of these span less than twice the template.
    unit = (longest + 1) ** 2
    reach = whole.orderBy(F.col("diagonal") * F.expr(f"{unit}L div length"))
    ahead = reach.rangeBetween(0, unit - longest)
    windows = (runs.filter(~fits)
               .withColumn("first", F.min("low").over(ahead)).withColumn("last", F.max("high").over(ahead))
               .withColumns({name: F.expr(f"bit_or({name})").over(ahead) for name in masks})
               .withColumn("coverage", share).filter(F.col("coverage") >= coverage)
               .withColumn("behind", F.max("coverage").over(reach.rangeBetween(longest - unit, -1)))
               .withColumn("best", F.max("coverage").over(ahead)))
    # of windows that overlap the best one stays, the first of equals
    windows = windows.filter((F.col("coverage") == F.col("best"))
                             & (F.col("behind").isNull() | (F.col("behind") < F.col("coverage"))))
    passages = merged.filter(F.col("coverage") >= coverage).select(*out).unionByName(windows.select(*out))
    return exact.unionByName(passages)


def scan(docs: DataFrame, coverage: float = COVERAGE, shift: int = SHIFT,
         passages: dict[str, str] = PASSAGES) -> DataFrame:
    """Per row of ``docs``: words, base places and their ends, labels and score.

    ``passages``: label to words in lower case, apart by one space, of any length.
    """
    masks, longest = masks_of(passages), max(row[-1] for row in templates(passages))
    # the few votes are written once: base places and passages both read them
    votes = materialize(diagonals(matches(docs, passages), masks), "license-votes")
    found = spans(votes, masks, longest, coverage, shift)
    labels = lambda c: F.array_join(F.sort_array(c), ",")
    base = F.when(F.col("base"), F.col("first"))
    per = found.groupBy("id", "version").agg(
        F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"),
        F.max(base).cast("long").alias("last_word"),
        labels(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        labels(F.collect_set("label")).alias("labels"), F.max("coverage").alias("score"))
    rows = docs.select("doc_id", doc_key().alias("id"), text_version().alias("version"), F.size(F.filter(
        F.split(text_or_empty(), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != ""))
        .cast("long").alias("n_words"))
    return rows.join(per, ["id", "version"], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLE: dict[str, str] = {}
