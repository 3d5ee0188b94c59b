"""License notices by an exact set-similarity join.

Templates and text blocks (lines) are sets of words.  A block is a match when
it holds at least the given share of a template's words.  Words are put in
one global order, rarest in the corpus first.  A match must then hold one of
the template's first ``|T| - need + 1`` words (prefix filter), have at least
``need`` template words (length filter), and, from the places of the first
common word in both sets, still be able to reach ``need`` (positional filter).
Survivors are counted exactly, so no block above the threshold is missed.

Notices wrapped over lines are found in windows of a document's words: for
every template that the document reaches as a whole, the window of as many
words as the template has, from each of its words on, is counted exactly.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorcast.llm.common import ascii_lower, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8

# Phrases whose places are counted, with their labels (fixed values).
PHRASES = (
    (("cc", "by"), "cc-by"),
    (("general", "public", "license"), "gpl"),
    (("all", "rights", "reserved"), "reserved"),
)

# Public license notices with the words that name the license, without which a block is no match (fixed values).
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an AS IS BASIS", "unless basis"),
    ("mit", "Released under the MIT License", "mit"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", "permission granted"),
    ("gpl", "This work is licensed under the GNU General Public License", "gnu general"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License", "gnu general"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met", "redistribution binary"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License", "mozilla"),
    ("cc-by", "Licensed under CC BY 4.0", "cc by"),
    ("cc-by-nc", "Licensed under CC BY NC 4.0", "cc by nc"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License", "creative commons attribution"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related rights to this work", "waived copyright"),
    ("reserved", "All rights reserved", "all rights reserved"),
)


def word_list(text: Column) -> Column:
    """The words of a text: lower-cased runs of ASCII letters and digits and
    non-ASCII characters."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall(WORD, text.lower())))


def _places(words: Column, phrase: tuple[str, ...]) -> Column:
    """First word positions of a phrase."""
    def here(i):
        same = F.lit(True)
        for k, w in enumerate(phrase):
            same = same & (F.get(words, i + k) == w)
        return same
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _base(words: Column, text: Column) -> Column:
    """Structs of position and label of all phrase places."""
    none = F.array().cast("array<struct<at:int,label:string>>")

    def marked(phrase, label):
        return F.transform(_places(words, phrase), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))
    parts = []
    for phrase, label in PHRASES:
        may = text.contains(max(phrase, key=len)) & F.array_contains(words, phrase[0]) & F.array_contains(words, phrase[-1])
        parts.append(F.when(may & (F.size(words) > 0), marked(phrase, label)).otherwise(none))
    return F.concat(*parts)


def _windows(kept: DataFrame, templates: DataFrame) -> DataFrame:
    """``(row, template, label, share)`` of templates found in a window of a document's words, whatever its lines."""
    reached = (kept.where("text is not null").join(
        F.broadcast(templates), F.size(F.array_intersect("hits", "t_words")) >= F.col("need"))
        .where(_names("hits")).select("row", "template", "label", "size", "need", "length", "t_words", "naming", word_list(F.col("text")).alias("words")))
    # written, or else the filter on common is pushed down and the words are made again for every place
    reached, _ = stored(reached, "license-words")
    # a window can begin at the first template word that it holds
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains("t_words", F.get("words", i)))
    held = F.transform(starts, lambda i: F.array_intersect(F.slice("words", i + 1, F.col("length")), F.col("t_words")))
    common = F.array_max(F.transform(held, lambda w: F.when(
        F.size(F.array_intersect(w, F.col("naming"))) == F.size("naming"), F.size(w)).otherwise(0)))
    return (reached.withColumn("common", common).where("common >= need")
            .select("row", "template", "label", (F.col("common") / F.col("size")).alias("share")))


def _names(words: str) -> Column:
    """The words hold all those that name the template's license."""
    return F.size(F.array_intersect(words, "naming")) == F.size("naming")


def _best(matched: DataFrame, place: list[str]) -> DataFrame:
    """``(row, label, share)`` without templates whose words are all in another one found in the same place."""
    inside = {i: [j for j, (_, other, _) in enumerate(TEMPLATES) if i != j and set(template_words(text)) < set(template_words(other))]
              for i, (_, text, _) in enumerate(TEMPLATES)}
    every = matched.groupBy(*place).agg(F.collect_set("template").alias("every"), F.collect_list(
        F.struct("template", "label", "share")).alias("m")).select("row", "every", F.explode("m").alias("m"))
    beaten = F.lit(False)
    for i, wider in inside.items():
        if wider:
            beaten = beaten | ((F.col("m.template") == i) & F.arrays_overlap("every", F.array(*[F.lit(j) for j in wider])))
    return every.where(~beaten).select("row", "m.label", "m.share")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)``.

    A template is found only where the words that name its license stand, and
    not where a wider template that holds all its words is found.  Null and
    empty texts have no words, places or labels and score 0.  Each
    input row gives one output row, repeated ones and those with a null
    ``doc_id`` too.  ``score`` is the largest share of a template found in a
    line or in a window of the template's length, 1 where a phrase stands, 0 where nothing reaches the threshold.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    templates = [(i, label, template_words(text)) for i, (label, text, _) in enumerate(TEMPLATES)]
    needs = {i: max(1, math.ceil(threshold * len(ws) - 1e-9)) for i, _, ws in templates}
    vocabulary = sorted({w for _, _, ws in templates for w in ws})

    text = F.coalesce(F.col("text"), F.lit(""))
    worded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")) \
        .withColumn("words", word_list(F.col("text")))
    hits = F.array_intersect("words", F.array(*[F.lit(w) for w in vocabulary]))
    seen = worded.select("doc_id", "text", F.size("words").cast("long").alias("n_words"),
                         _base(F.col("words"), ascii_lower(F.col("text"))).alias("base"), hits.alias("hits"))
    # a line can only reach a template when its document does
    may = F.lit(False)
    for i, _, ws in templates:
        may = may | (F.size(F.array_intersect("hits", F.array(*[F.lit(w) for w in ws]))) >= needs[i])
    kept = seen.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "base", "hits",
                       F.when(F.size("hits") > 0, F.when(may, F.col("text"))).alias("text"))
    kept, _ = stored(kept, "license-docs")

    counts = {r["w"]: r["n"] for r in kept.select(F.explode("hits").alias("w")).groupBy("w")
              .agg(F.count(F.lit(1)).alias("n")).collect()}  # the template vocabulary at most
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    prefix_rows, sets = [], []
    for i, label, ws in templates:
        ranked = sorted(ws, key=order.__getitem__)
        sets.append((i, label, len(ranked), needs[i], ranked, TEMPLATES[i][2].split()))
        prefix_rows += [(i, w, place) for place, w in enumerate(ranked[:len(ranked) - needs[i] + 1])]
    # both tables are fixed by the templates
    prefixes = F.broadcast(spark.createDataFrame(prefix_rows, "template int, w string, t_place int"))
    members = F.broadcast(spark.createDataFrame(sets, "template int, label string, size int, need int, t_words array<string>, naming array<string>"))

    lengths = spark.createDataFrame([(i, len(re.findall(WORD, text.lower()))) for i, (_, text, _) in enumerate(TEMPLATES)],
                                    "template int, length int")

    rank = F.create_map(*[F.lit(x) for w, k in order.items() for x in (w, k)])
    lines = (kept.where("text is not null")
             .select("row", F.posexplode(F.split("text", "\n")).alias("line", "block"))
             .select("row", "line", F.array_intersect(word_list(F.col("block")), F.array(*[F.lit(w) for w in vocabulary])).alias("b"))
             .where(F.size("b") > 0)
             .withColumn("b", F.transform(F.array_sort(F.transform("b", lambda w: F.struct(rank[w].alias("k"), w.alias("w")))),
                                          lambda s: s["w"])))
    joined = (lines.select("row", "line", "b", F.posexplode("b").alias("b_place", "w")).join(prefixes, "w")
              .join(members, "template")
              .where(F.size("b") >= F.col("need"))
              .where(1 + F.least(F.col("size") - F.col("t_place") - 1, F.size("b") - F.col("b_place") - 1)
                     + F.least("t_place", "b_place") >= F.col("need")))
    matched = (joined.where(_names("b")).withColumn("common", F.size(F.array_intersect("b", "t_words"))).where("common >= need")
               .groupBy("row", "line", "template").agg(F.first("label").alias("label"), F.max(F.col("common") / F.col("size")).alias("share")))
    matched = (_best(matched, ["row", "line"]).unionByName(_best(_windows(kept, lengths.join(members, "template")), ["row"]))
               .groupBy("row").agg(F.collect_set("label").alias("found"), F.max("share").alias("share")))

    out = kept.drop("text", "hits").join(matched, "row", "left")
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda s: s["label"])))
    every = F.array_sort(F.array_distinct(F.concat(base_labels, F.coalesce("found", F.array().cast("array<string>")))))
    at = F.transform("base", lambda s: s["at"].cast("long"))
    return out.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                      F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
                      F.array_join(base_labels, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                      F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
