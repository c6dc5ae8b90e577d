"""Operator 1: license scans by diagonal voting.

Every rolling word k-gram of every document is hashed and joined to the
positions where license templates have it.  A hit votes for the diagonal
``document position - template position``: an unaltered copy puts all its
votes on one diagonal, an edit moves later votes to a neighbouring one.
Votes are summed per diagonal, neighbouring diagonals merged into spans, and
a span counts when it covers enough of the template's k-grams, compared word
by word.  Short phrases (``k = 2``) must match whole, on one diagonal.

Words: A-Z lower-cased, separated by ASCII characters that are neither
letters nor digits.  Null and empty texts have no words and no spans.
Repeated rows are scanned each for itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM_SEPARATORS


class Template(NamedTuple):
    label: str
    words: str
    k: int = 4
    phrase: bool = False     # whole matches only; what the base columns count


# License phrases and wording of well-known license notices.
TEMPLATES = (
    Template("mit", "mit license", 2, True),
    Template("apache", "apache license", 2, True),
    Template("gpl", "general public license", 2, True),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
                    "and associated documentation files the software to deal in the software without restriction"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of "
                       "the license at"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
                    "gnu general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under the creative commons attribution sharealike license"),
)
# Diagonals this close belong to one copy with words added or missing.
GAP = 3
# Share of a template's k-grams a span must cover.
MIN_COVERAGE = 0.6


def _lower(text: Column) -> Column:
    """A-Z in lower case.  ``lower`` also maps other letters, which keeps words apart
    as before; the only two it maps to ASCII letters are set aside."""
    odd = text.contains("\u212a") | text.contains("\u0130")
    return F.lower(F.when(odd, F.translate(text, "\u212a\u0130", "\ue000\ue001")).otherwise(text))


def _grams(spark, templates: tuple[Template, ...], k: int, name: str) -> DataFrame:
    """``hash, <name>``: the (template, position, gram) entries of each k-gram hash; as many rows as the templates have grams."""
    rows = []
    for t, template in enumerate(templates):
        words = template.words.split()
        if template.k == k:
            rows += [(t, i, words[i:i + k]) for i in range(len(words) - k + 1)]
    made = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(i).alias("i"), F.array(*map(F.lit, w)).alias("w")) for t, i, w in rows
    ])).alias("g"))
    return made.groupBy(F.xxhash64(*[F.col("g.w")[j] for j in range(k)]).alias(f"{name}_hash")).agg(
        F.collect_list("g").alias(name))


def _same_words(grams: str, here: Column) -> Column:
    """The words decide, not their hash."""
    return F.filter(grams, lambda g: g["w"] == here)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, gap: int = GAP) -> DataFrame:
    """One row per document row and span, and one without span per document row:
    ``row, doc_id, n_words, t, start, stop, coverage``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        # The empty word in front stands for the document itself, so that none gets lost.
        F.concat(F.array(F.lit("")), F.array_remove(F.split(_lower(F.coalesce("text", F.lit(""))), ALNUM_SEPARATORS), ""))
        .alias("words"))
    at = rows.select("row", "doc_id", "words", F.posexplode("words").alias("p", "word"))
    hits = F.array().cast("array<struct<t:int,i:int,w:array<string>>>")
    for k in sorted({t.k for t in templates}):
        gram = [F.col("word")] + [F.get("words", F.col("p") + j) for j in range(1, k)]
        name = f"k{k}"
        at = at.withColumn(f"{name}_at", F.xxhash64(*gram)).join(
            F.broadcast(_grams(spark, templates, k, name)), F.col(f"{name}_at") == F.col(f"{name}_hash"), "left")
        same = _same_words(name, F.slice("words", F.col("p") + 1, k))
        hits = F.concat(hits, F.when(F.col(name).isNotNull(), same).otherwise(
            F.array().cast("array<struct<t:int,i:int,w:array<string>>>")))
    found = " or ".join(f"k{k}_hash is not null" for k in sorted({t.k for t in templates}))
    votes = at.where(f"p = 0 or {found}").select(
        "row", "doc_id", "p", F.when(F.col("p") == 0, F.size("words") - 1).cast("long").alias("n_words"),
        F.explode_outer(hits).alias("hit"))
    diagonals = votes.where("p = 0 or hit is not null").groupBy(
        "row", "doc_id", F.col("hit.t").alias("t"), (F.col("p") - 1 - F.col("hit.i")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"), F.min("p").alias("low"), F.max("p").alias("high"),
        F.collect_set("hit.i").alias("seen"))
    phrases = [i for i, t in enumerate(templates) if t.phrase]
    order = Window.partitionBy("row", "doc_id", "t").orderBy("diagonal")
    apart = F.when(F.col("t").isin(phrases), F.lit(0)).otherwise(F.lit(gap))
    begins = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > apart).cast("int"), F.lit(0))
    spans = diagonals.withColumn("begins", begins).withColumn("span", F.sum("begins").over(order)).groupBy(
        "row", "doc_id", "t", "span").agg(
        F.max("n_words").alias("n_words"), (F.min("low") - 1).cast("long").alias("start"),
        F.max("high").cast("long").alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("n_seen"))
    size = F.element_at(F.array(*[F.lit(len(t.words.split()) - t.k + 1) for t in templates]), F.col("t") + 1)
    width = F.element_at(F.array(*[F.lit(t.k) for t in templates]), F.col("t") + 1)
    return spans.select("row", "doc_id", "n_words", "t", F.when(F.col("t").isNotNull(), F.col("start")).alias("start"),
                        (F.col("last") - 1 + width).alias("stop"), (F.col("n_seen") / size).alias("coverage"))


def verdicts(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
             min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Per document row: words, places of the whole phrases, labels and score
    (largest coverage of any span; 0 without hits)."""
    label = F.element_at(F.array(*[F.lit(t.label) for t in templates]), F.col("t") + 1)
    phrase = F.coalesce(F.col("t").isin([i for i, t in enumerate(templates) if t.phrase]), F.lit(False))
    base = phrase & (F.col("coverage") >= 1)
    good = base | (~phrase & (F.col("coverage") >= min_coverage))
    joined = lambda names: F.array_join(F.sort_array(F.collect_set(names)), ",")
    return scan(docs, templates).groupBy("row", "doc_id").agg(
        F.max("n_words").alias("n_words"), F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.when(base, label)).alias("base_labels"), joined(F.when(good, label)).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score")).drop("row")
