"""License scan: exact phrases, and an exact set-similarity join with license templates.

A block is a window of consecutive words. A template matches a block when the
block holds at least `threshold` of the template's distinct words. Every
template is met by windows of its own scale (twice the power of two at or above
its number of words, one at every half window), so any passage as long as the template
lies whole in one window; a window at the end of a text may be shorter.

The join is a prefix-filter join, in DataFrame functions only:
  - the templates' words are counted over the whole corpus and ordered from the
    rarest to the commonest; blocks and templates are lists in that order (words
    of no template cannot match and are left out);
  - to share `need` words, a template's first |T| - need + 1 words and a
    block's first |B| - need + 1 words must meet, so only those are joined;
  - blocks with fewer than `need` words go (length filter), and pairs whose meeting
    place leaves fewer than `need` possible common words go (positional filter);
  - the common words of the pairs that are left are counted.
Filters drop only pairs that cannot match. Templates are a parameter and small:
their prefix words are a broadcast table, so blocks are never shuffled; texts
without any prefix word are not cut into blocks at all.

Defined results: a null text is empty; an empty or wordless text has no block;
repeated rows each get the result of their text, null ids too; a template
without words never matches; templates with one label are alternatives; empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import written

# Phrases that are found word for word, and their labels (fixed by the task).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public license notices: label, text. Callers may pass their own list.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
THRESHOLD = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a whole text, A-Z in lower case; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _SEPARATORS), "")


def template_words(text: str) -> list[str]:
    lower = text.translate(str.maketrans(_UPPER, _LOWER))
    return [w for w in re.split(_SEPARATORS, lower) if w]


# -- phrases -------------------------------------------------------------------
def phrase_starts(words: Column, phrase: str) -> Column:
    """Word numbers (from 0) at which the phrase's words stand in a row."""
    parts = phrase.split(" ")
    here = lambda i: _all(F.get(words, i + k) == p for k, p in enumerate(parts))
    # Most texts lack one of the words: they are not walked.
    walk = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.coalesce(here(i), F.lit(False)))
    return F.when(_all(F.array_contains(words, p) for p in parts), walk).otherwise(F.array().cast("array<int>"))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


# -- templates -----------------------------------------------------------------
@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]  # distinct, the rarest in the corpus first
    need: int               # common words that make a match
    scale: int              # step of the windows; a window has twice as many words

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[:len(self.words) - self.need + 1]


def needed(text: str, threshold: float) -> int:
    """Distinct words of a template that a block must hold."""
    return math.ceil(threshold * len(set(template_words(text))) - 1e-9)


def scale_of(text: str) -> int:
    """Half the size of the windows that meet a template."""
    return 1 << max(2, math.ceil(math.log2(max(1, len(template_words(text))))))


def order_templates(words: DataFrame, templates, threshold: float = THRESHOLD) -> tuple[list[Template], list[str]]:
    """Templates with their words in corpus order, and that order itself.

    `words` has one column `words`. Counts come from all its rows; the answer
    has at most as many rows as the templates have distinct words.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    distinct = [sorted(set(template_words(t))) for _, t in templates]
    vocabulary = sorted({w for ws in distinct for w in ws})
    spark = words.sparkSession
    known = F.broadcast(spark.createDataFrame([(w,) for w in vocabulary], "word string"))
    counted = (words.select(F.explode("words").alias("word")).join(known, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    n = {r["word"]: r["n"] for r in counted.collect()}  # at most the templates' distinct words
    order = sorted(vocabulary, key=lambda w: (n.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    out = [Template(i, label, tuple(sorted(ws, key=rank.get)), needed(text, threshold), scale_of(text))
           for i, ((label, text), ws) in enumerate(zip(templates, distinct, strict=True)) if ws]
    return out, order


def _strings(values) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def matching_blocks(texts: DataFrame, templates: list[Template], order: list[str]) -> DataFrame:
    """All (block, template) pairs that reach the threshold: the other columns of
    `texts` (which has `words`), `label`, `template`, `block` (its number),
    `first` (its first word's number), `n_common` and `containment`."""
    spark = texts.sparkSession
    keep = [c for c in texts.columns if c != "words"]
    scales = sorted({t.scale for t in templates})
    if not templates:
        blocks = texts.where("false").withColumn("scale", F.lit(0))
    else:
        any_prefix = _strings(sorted({w for t in templates for w in t.prefix}))
        near = texts.where(F.arrays_overlap("words", any_prefix)).select(*keep, "words", F.explode(F.array(*map(F.lit, scales))).alias("scale"))
        # A window begins at every step; the one that would hold no further word is left out.
        n = F.size("words")
        numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / F.col("scale")).cast("int") - 2))
        blocks = near.select(*keep, "words", "scale", F.explode(numbers).alias("block"))
    of_scale = F.lit(None).cast("array<string>")
    least = F.lit(None).cast("int")
    for s in scales:  # the words, in corpus order, that templates of this scale have
        own = {w for t in templates if t.scale == s for w in t.words}
        of_scale = F.when(F.col("scale") == s, _strings([w for w in order if w in own])).otherwise(of_scale)
        least = F.when(F.col("scale") == s, F.lit(min(t.need for t in templates if t.scale == s))).otherwise(least)
    if not templates:
        blocks = blocks.withColumn("block", F.lit(0))
    window = F.slice("words", F.col("block") * F.col("scale") + 1, F.col("scale") * 2)
    sets = (blocks.withColumn("b", F.array_intersect(of_scale, window)).withColumn("least", least).drop("words")
            .where(F.size("b") >= F.col("least")))
    prefixes = sets.select("*", F.posexplode(F.slice("b", F.lit(1), F.size("b") - F.col("least") + 1)).alias("j", "word"))
    index = spark.createDataFrame([(t.scale, w, i, t.number, t.label, list(t.words), t.need) for t in templates for i, w in enumerate(t.prefix)],
                                  "scale int, word string, i int, template int, label string, t array<string>, need int")
    met = prefixes.join(F.broadcast(index), ["scale", "word"]).where(
        (F.size("b") >= F.col("need")) & (F.col("j") <= F.size("b") - F.col("need"))
        & (F.least(F.size("t") - F.col("i"), F.size("b") - F.col("j")) >= F.col("need")))
    common = F.array_intersect("t", "b")
    # A pair may meet in several prefix words: the first common one stands for it.
    return (met.withColumn("common", common).where((F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("word")))
            .select(*keep, "label", "template", "scale", "block", (F.col("block") * F.col("scale")).alias("first"),
                    F.size("common").alias("n_common"), (F.size("common") / F.size("t")).alias("containment")))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: the id, `n_words`, `n_base` places of phrases, `first_word` and
    `last_word` (least and greatest start), `base_labels`, `labels` and `score`.

    `labels` are the phrases' labels and those of matching templates; `score`
    is the greatest share of a phrase or template that a block holds, 0
    where nothing was found.
    """
    phrases = PHRASES if phrases is None else phrases
    # Rows with equal ids and texts have equal results, so this key is enough to join them back.
    rows = docs.select(F.col(id_col).alias("doc_id"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("digest"),
                       words_of(F.col(text_col)).alias("words"))
    ordered, order = order_templates(rows.select("words"), templates, threshold)
    for k, (phrase, _) in enumerate(phrases.items()):
        rows = rows.withColumn(f"p{k}", phrase_starts(F.col("words"), phrase))
    starts = F.concat(*[F.col(f"p{k}") for k in range(len(phrases))]) if phrases else F.array().cast("array<int>")
    names = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(phrases.values())])
                            .cast("array<string>"))
    base = rows.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"), F.size(starts).cast("long").alias("n_base"),
                       F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
                       F.array_sort(F.array_distinct(names)).alias("base"))
    found = written(matching_blocks(rows.select("doc_id", "digest", "words"), ordered, order)
                    .groupBy("doc_id", "digest").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best")), "license_blocks")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    b, m = base.alias("b"), found.alias("m")
    return (b.join(m, (F.col("b.digest") == F.col("m.digest")) & F.col("b.doc_id").eqNullSafe(F.col("m.doc_id")), "left")
            .select("b.doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                    F.array_join(labels, ",").alias("labels"), score.alias("score")))
