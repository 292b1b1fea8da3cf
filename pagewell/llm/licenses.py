"""License scans by diagonal voting.

Every rolling word k-gram of a document is joined to the places where it stands
in a template. A hit votes for the diagonal document position minus template
position; one run of text copied from a template puts all its votes on one
diagonal, an insertion or deletion moves the rest to a neighbouring one. Votes
are summed by diagonal, neighbouring diagonals are merged, and a merged span
counts if the template words it covers are a large enough share. A span inside a
longer one is left out if it covers part of its template only, and no word that the longer one doesn't.

Phrases are templates that must be covered whole, on one diagonal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewell.functions import select_once
from pagewell.llm.common import BROADCAST_ROWS, gram_hash, gram_hashes, keyed, restore_copies, words, written

GRAM_WORDS = 4
# Diagonals at most this far apart belong to one span.
SLACK = 4
# Least share of a template's words that a span must cover.
COVERAGE = 0.6

# --- fixed values: phrases, and public license notices with their labels ------
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike license"),
]


def template_table(spark: SparkSession, phrases=None, templates=None) -> DataFrame:
    """``tid, label, phrase, text``."""
    listed = [(label, True, text) for label, text in (PHRASES if phrases is None else phrases)]
    listed += [(label, False, text) for label, text in (TEMPLATES if templates is None else templates)]
    rows = [(tid, *row) for tid, row in enumerate(listed)]
    return spark.createDataFrame(rows, "tid int, label string, phrase boolean, text string")


def _template_grams(templates: DataFrame, gram: int) -> DataFrame:
    """``tid, label, phrase, size, k, tpos, gram, h``: phrases in grams of two
    words (or one), others in grams of ``gram`` words or all of a shorter one."""
    cut = select_once(templates, ["tid", "label", "phrase"], words(F.col("text")).alias("tw"))
    size = F.size("tw")
    k = F.least(size, F.when(F.col("phrase"), 2).otherwise(gram))
    placed = cut.where(size > 0).select(
        "tid", "label", "phrase", "tw", size.alias("size"), k.alias("k"), F.explode(F.sequence(F.lit(0), size - k)).alias("tpos"),
    )
    placed = placed.withColumn("gram", F.slice("tw", F.col("tpos") + 1, F.col("k"))).drop("tw")
    return placed.withColumn("h", gram_hash(F.col("gram")))


def _votes(docs: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """Votes of each document row, and one marker row with a null ``tid`` each.
    The explode, the join and the comparison of the words are one stage."""
    base, start = F.lit(1), None
    for k in sizes:
        position = F.col("p") - base
        start = F.when(F.col("k") == k, position) if start is None else start.when(F.col("k") == k, position)
        base = base + F.greatest(F.lit(0), F.size("w") - (k - 1))
    marker = grams.sparkSession.range(1).select(
        *[F.lit(None).cast(grams.schema[c].dataType).alias(c) for c in grams.columns if c != "h"],
        F.lit(0).cast("bigint").alias("h"),
    )
    table = grams.unionByName(marker)
    if grams.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    cut = select_once(keyed(docs, "text"), ["doc_id", "text_key"], words(F.col("text")).alias("w"))
    arrays = [gram_hashes(F.col("w"), k) for k in sizes]
    shingled = select_once(cut, ["doc_id", "text_key", "w"], F.concat(F.array(F.lit(0).cast("bigint")), *arrays).alias("hashes"))
    positions = shingled.select("doc_id", "text_key", "w", F.posexplode("hashes").alias("p", "hash"))
    same = F.slice("w", start + 1, F.col("k")) == F.col("gram")
    condition = (F.col("hash") == F.col("h")) & (((F.col("p") == 0) & F.col("k").isNull()) | same)
    return positions.join(table, condition).select(
        "doc_id", "text_key", F.size("w").cast("bigint").alias("n_words"),
        "tid", "label", "phrase", "size", "k", "tpos", (start - F.col("tpos")).alias("diagonal"),
    )


def _spans(votes: DataFrame, slack: int, coverage: float) -> DataFrame:
    """Verified spans: ``doc_id, text_key, n_words, n_rows, label, phrase, start,
    end, coverage``; a document without spans keeps one row with a null label."""
    key = ["doc_id", "text_key", "n_words"]
    diagonals = votes.groupBy(*key, "tid", "label", "phrase", "size", "k", "diagonal").agg(
        F.collect_set("tpos").alias("tpos"), F.count("*").alias("n"),
    )
    by_template = Window.partitionBy(*key, "tid").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_template)
    apart = F.when(F.col("phrase") | gap.isNull() | (gap > slack), 1).otherwise(0)
    grouped = diagonals.withColumn("apart", apart).withColumn("span", F.sum("apart").over(by_template)).drop("apart")
    merged = grouped.groupBy(*key, "tid", "label", "phrase", "size", "k", "span").agg(
        F.flatten(F.collect_list("tpos")).alias("tpos"),
        F.flatten(F.collect_list(F.transform("tpos", lambda t: F.col("diagonal") + t))).alias("at"),
        F.min(F.col("diagonal") + F.array_min("tpos")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("tpos") + F.col("k")).alias("end"),
        F.sum("n").alias("n"),
    )
    words_from = lambda starts: F.array_distinct(F.flatten(F.transform(starts, lambda t: F.sequence(t, t + F.col("k") - 1))))
    share = F.size(words_from("tpos")) / F.col("size")
    kept = merged.select("*", F.when(F.col("tid").isNotNull(), share).alias("coverage")).where(
        F.col("tid").isNull() | (F.col("coverage") >= F.when(F.col("phrase"), 1.0).otherwise(coverage))
    )
    kept = kept.withColumn("covers", F.when(~F.col("phrase"), words_from("at")))
    # A span inside a longer one of another template is part of that, unless it is whole or covers words that the longer one doesn't.
    reach = F.when(~F.col("phrase"), F.struct("end", (-F.col("start")).alias("before"), "covers"))
    by_start = Window.partitionBy(*key).orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    longest = F.max(reach).over(by_start)
    inside = (longest["end"] > F.col("end")) | ((longest["end"] == F.col("end")) & (-longest["before"] < F.col("start")))
    part = (F.col("coverage") < 1) & (F.size(F.array_except("covers", longest["covers"])) == 0)
    marked = kept.withColumn("inside", ~F.col("phrase") & F.coalesce(inside & part, F.lit(False)))
    return marked.where("tid IS NULL OR NOT inside").select(
        *key, F.when(F.col("tid").isNull(), F.col("n")).alias("n_rows"), "label", "phrase", "start", "end", "coverage"
    )


def scan_licenses(
    docs: DataFrame, phrases=None, templates=None, gram: int = GRAM_WORDS, slack: int = SLACK, coverage: float = COVERAGE,
) -> DataFrame:
    """``doc_id, n_words, spans``, one row per document: ``spans`` sorted structs
    ``(start, end, label, phrase, coverage)`` in words.

    A null or empty text has no words and no spans; a phrase counts at every
    place it stands, overlapping ones too. A template span inside a longer one is
    left out if it covers part of its template, and only words the longer one covers too. Equal templates with other labels give a span
    each. Repeated rows come back as often as given, rows of one id with other
    texts each for themselves. Other columns are not read. With more template
    grams than ``BROADCAST_ROWS`` the join is an ordinary one.
    """
    grams = written(_template_grams(template_table(docs.sparkSession, phrases, templates), gram), "template-grams")
    sizes = sorted(r.k for r in grams.select("k").distinct().collect())
    spans = _spans(_votes(docs, grams, sizes), slack, coverage)
    span = F.struct("start", "end", "label", "phrase", "coverage")
    found = spans.groupBy("doc_id", "text_key", "n_words").agg(
        F.max("n_rows").alias("n_rows"),
        F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), span))).alias("spans"),
    )
    return restore_copies(found, "n_rows").select("doc_id", "n_words", "spans")


def license_report(docs: DataFrame) -> DataFrame:
    """Counts, first and last place of the base phrases, labels and a score."""
    found = scan_licenses(docs)
    base = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["start"].cast("bigint"))
    label = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        label(base).alias("base_labels"), label(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )
