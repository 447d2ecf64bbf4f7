"""License scan as an exact set-similarity join of text blocks with license templates, in built-in functions only.

A block is a line of a text; blocks and templates are sets of words. A template is found where a block holds at least
the threshold share of its words. Words of the templates are ordered by how many documents hold them, rarest first;
a template of n words that needs o of them is met by a block only if one of its n - o + 1 rarest words (its prefix) is in
the prefix of the block. Texts without any prefix word are passed over by plain substring tests on their spaced words; the blocks of the
others are matched by prefix word, with the length filter (the block has o template words at all) and the positional
filter (enough words stand behind the matching ones), and verified by intersection. All filters are lossless.

Only template words are counted and ordered, so the broadcast index is bounded by the templates. Blocks are rows of
their own and meet again by document through partial aggregates.

Defined cases: null and empty texts have no words, places or labels and score 0; repeated rows are judged one by one;
null ids pass through; an empty table gives an empty result; texts of any length are read whole; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the task: phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Texts of well-known licenses and notices, by label.
TEMPLATES = [
    ("agpl-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved. No part of this publication may be reproduced without prior written permission"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    import re

    return sorted({w.lower() for w in re.findall(WORDS, text)})


def needed(size: int, threshold: float) -> int:
    """Least number of a template's words that reaches the threshold."""
    return next(o for o in range(size + 1) if o >= threshold * size - 1e-9)


def _lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_order(docs: DataFrame, templates, text: str = "text") -> list[str]:
    """The words of the templates, by the number of documents that hold them."""
    every = sorted({w for _, t in templates for w in template_words(t)})
    held = docs.select(F.explode(F.array_intersect(_words(every), F.split(_lowered(docs[text].cast("string")), GAPS))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most the template words
    return sorted(every, key=lambda w: (counts.get(w, 0), w))


def phrase_places(text: Column, n_words: Column) -> list[Column]:
    """n_base, first_word, last_word and base_labels of a text that may hold a phrase.

    Every word stands between blanks of its own, so phrases that follow each other are both seen.
    """
    spaced = F.regexp_replace(F.concat(F.lit(" "), _lowered(text), F.lit(" ")), GAPS, "  ")
    blanks = lambda part: (F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit(""))) - 1) / 2  # noqa: E731  words of a part
    numbers, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        mark = " " + phrase.replace(" ", "  ") + " "
        number = ((F.length(spaced) - F.length(F.replace(spaced, F.lit(mark), F.lit("")))) / len(mark)).cast("bigint")
        numbers.append(number)
        firsts.append(F.when(number > 0, blanks(F.substring_index(spaced, mark, 1)).cast("bigint")))
        lasts.append(F.when(number > 0, n_words - blanks(F.substring_index(spaced, mark, -1)).cast("bigint") - len(phrase.split())))
        labels.append(F.when(number > 0, F.lit(label)))
    return [sum(numbers[1:], numbers[0]), F.array_min(F.array(*firsts)), F.array_max(F.array(*lasts)), F.array_sort(F.array_compact(F.array(*labels)))]


def _any_in(spaced: Column, words: list[str]) -> Column:
    """One of the words stands in a text whose words have single blanks around them."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(spaced, F.lit(f" {w} "))
    return out


def scan(docs: DataFrame, templates=None, threshold: float = THRESHOLD, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document."""
    templates = TEMPLATES if templates is None else templates
    order = word_order(docs, templates, text)
    rank = {w: i for i, w in enumerate(order)}
    sets = [(label, sorted(template_words(t), key=rank.get)) for label, t in templates]
    sets = [(label, words, needed(len(words), threshold)) for label, words in sets if words]
    prefixes = sorted({w for _, words, o in sets for w in words[: len(words) - o + 1]})
    entries = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(label).alias("label"), F.lit(i).alias("at"), F.lit(o).alias("needed"), _words(words).alias("template"))
                        for label, words, o in sets for i, w in enumerate(words[: len(words) - o + 1])])
    index = docs.sparkSession.range(1).select(F.explode(entries).alias("e")).select("e.*")

    value = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[id_column].alias("doc_id"), value.alias("text"), F.monotonically_increasing_id().alias("row"))
    # " w1 w2 ... ": whole words are found as substrings; `lower` also folds letters beyond ASCII, which only adds candidates.
    rows = rows.withColumn("spaced", F.regexp_replace(F.concat(F.lit(" "), F.lower("text"), F.lit(" ")), GAPS, " "))
    blanks = F.length("spaced") - F.length(F.replace(F.col("spaced"), F.lit(" "), F.lit("")))
    rows = rows.select("row", "doc_id", "text", "spaced", (blanks - 1).cast("bigint").alias("n_words"))
    places = phrase_places(F.col("text"), F.col("n_words"))
    marks = sorted({max(p.split(), key=lambda w: (w in ("cc",), len(w))) for p in PHRASES})
    none = [F.lit(0).cast("bigint"), F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), F.array().cast("array<string>")]
    named = lambda values: F.named_struct(*[x for n, v in zip("nflb", values) for x in (F.lit(n), v)])
    base = F.when(_any_in(F.col("spaced"), marks), named(places)).otherwise(named(none))
    lines = F.when(_any_in(F.col("spaced"), prefixes), F.filter(F.split(_lowered(F.col("text")), "\n"), lambda x: F.arrays_overlap(F.split(x, GAPS), _words(prefixes))))
    keys = ["row", "doc_id", "n_words", "base"]
    rows = rows.select("row", "doc_id", "n_words", base.alias("base"), F.explode_outer(lines).alias("line"))
    block = F.array_intersect(_words(order), F.split("line", GAPS))  # template words of the block, rarest first
    least = min((o for _, _, o in sets), default=1)
    rows = rows.withColumn("block", F.when(F.col("line").isNotNull(), block)).drop("line")
    front = F.when(F.size("block") >= least, F.slice("block", F.lit(1), F.greatest(F.size("block") - least + 1, F.lit(1))))
    met = rows.select(*keys, "block", F.posexplode_outer(front).alias("place", "word")).join(F.broadcast(index), "word", "left")
    behind = F.least(F.size("template") - F.col("at"), F.size("block") - F.col("place"))
    common = F.size(F.array_intersect("block", "template"))
    held = (F.size("block") >= F.col("needed")) & (behind >= F.col("needed")) & (common >= F.col("needed"))
    met = met.select(*keys, F.when(held, F.col("label")).alias("label"), F.when(held, common / F.size("template")).alias("share"))
    found = met.groupBy(*keys).agg(F.collect_set("label").alias("own"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"))
    return found.select("doc_id", "n_words", F.col("base.n").alias("n_base"), F.col("base.f").alias("first_word"), F.col("base.l").alias("last_word"),
                        F.array_join("base.b", ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union("base.b", "own")), ",").alias("labels"), "score")
