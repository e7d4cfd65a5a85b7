"""License scans: an exact set-similarity join of text blocks with license templates, in DataFrame operations.

A text is cut into overlapping blocks of words. A block contains a template if it has at least `threshold` of the
template's distinct words. The join is a prefix-filter join: with words ordered by how often the corpus has them,
rarest first, a template that is contained shares one of its first words with the block. Only these words are looked
up; length and position filters drop hopeless pairs before the verification counts the overlap.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.llm.common import LOWER, UPPER, row_key, unfolded

# What separates words: ASCII signs other than letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Words of a block, and words between the starts of two blocks: a template no longer than their difference lies whole
# in some block wherever it starts.
BLOCK = 128
STEP = 64
THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    """`exact`: its words have to stand consecutively, and the places are counted."""

    name: str
    label: str
    text: str
    exact: bool = False


# Fixed phrases and labels.
PHRASES = (
    Template("gnu general public license", "gpl", "gnu general public license", True),
    Template("apache license", "apache", "apache license", True),
    Template("cc by", "cc-by", "cc by", True),
    Template("mit license", "mit", "mit license", True),
)
# Public notices of well-known licenses, shortened to the sentence by which they are known.
NOTICES = (
    Template("apache-notice", "apache-2.0", "licensed under the apache license version 2.0 you may not use this file "
             "except in compliance with the license"),
    Template("apache-line", "apache-2.0", "licensed under the apache license version 2.0"),
    Template("gpl-notice", "gpl-notice", "this program is free software you can redistribute it and or modify it under "
             "the terms of the gnu general public license as published by the free software foundation"),
    Template("mit-notice", "mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of "
             "this software and associated documentation files to deal in the software without restriction"),
    Template("bsd-notice", "bsd", "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met"),
    Template("mpl-notice", "mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    Template("cc-line", "cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international "
             "license"),
    Template("cc-by-sa-line", "cc-by-sa", "licensed under cc by sa"),
)
TEMPLATES = PHRASES + NOTICES


def split_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text) if w]


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def needed(size: int, threshold: float) -> int:
    """Words of a template of `size` distinct words that a block has to have."""
    return max(1, math.ceil(round(threshold * size, 9)))


def word_order(docs: DataFrame, templates: tuple[Template, ...]) -> dict[str, int]:
    """Rank of every template word by its number of occurrences in all documents, rarest first, ties by the word.

    One pass; only template words are counted, and they are summed in the map tasks.
    """
    vocabulary = sorted({w for t in templates for w in split_words(t.text)})
    words = docs.select(F.explode(words_of(F.col("text"))).alias("word")).filter(F.col("word").isin(vocabulary))
    counts = {r["word"]: r["n"] for r in words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def template_index(docs: DataFrame, templates: tuple[Template, ...], order: dict[str, int],
                   threshold: float) -> DataFrame:
    """word, place, template, size, need, ranks, phrase: a row for each prefix word of each template.

    Its size is that of the templates' texts, whatever the corpus: they are a parameter.
    """
    rows = []
    for number, template in enumerate(templates):
        words = split_words(template.text)
        ranks = sorted({order[w] for w in words})
        need = needed(len(ranks), 1.0 if template.exact else threshold)
        spelled = {rank: word for word, rank in order.items()}
        for place in range(len(ranks) - need + 1):
            rows.append((spelled[ranks[place]], place, number, len(ranks), need, ranks,
                         words if template.exact else None))
    names = ("_word", "place", "template", "size", "need", "ranks", "phrase")
    schema = ("array<struct<_word:string,place:int,template:int,size:int,need:int,ranks:array<int>,"
              "phrase:array<string>>>")
    text = json.dumps([dict(zip(names, row)) for row in rows])
    return docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), schema)))


def _ranks(words: Column, order: dict[str, int]) -> Column:
    """Distinct ranks of a block's template words, ascending; other words cannot match."""
    table = F.create_map(*[x for w, r in order.items() for x in (F.lit(w), F.lit(r))])
    known = F.filter(words, lambda w: w.isin(list(order)))
    return F.sort_array(F.array_distinct(F.transform(known, lambda w: F.element_at(table, w))))


def hits(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD,
         block: int = BLOCK, step: int = STEP) -> DataFrame:
    """Verified (doc key, block, template) rows of `docs` (key, text): score and the places of exact phrases.

    A block k has the words from k * step on. Every prefix word that stands in a text names the one or two blocks it
    lies in; a pair that several prefix words name is verified once, at its first common word.
    """
    longest = max([len(split_words(t.text)) for t in templates if t.exact], default=0)
    if longest > block - step:
        raise ValueError("a phrase has to fit into the overlap of two blocks")
    order = word_order(docs, templates)
    index = template_index(docs, templates, order, threshold)
    looked_up = sorted({r["_word"] for r in index.select("_word").collect()})
    words = docs.select("key", words_of(F.col("text")).alias("words"))
    places = words.select("key", "words", F.posexplode("words").alias("at", "word")).filter(F.col("word").isin(looked_up))
    last = F.floor(F.col("at") / step)
    first = F.greatest(F.floor((F.col("at") - block) / step) + 1, F.lit(0))
    named = places.select("key", "words", "at", "word", F.explode(F.sequence(first, last)).alias("block"))
    start = (F.col("block") * step).cast("int")
    named = named.withColumn("text", F.slice("words", start + 1, block)).drop("words")
    # Of a word that repeats in a block, the first place speaks for the others.
    named = named.filter(F.array_position("text", F.col("word")) == F.col("at") - start + 1)
    named = named.withColumn("found", _ranks(F.col("text"), order))
    pairs = named.join(F.broadcast(index), named["word"] == index["_word"], "inner")
    rank = F.element_at("ranks", F.col("place") + 1)
    # Length filter; then the position filter: what can still follow on either side, with this word, must suffice.
    pairs = pairs.filter(F.size("found") >= F.col("need"))
    here = F.array_position("found", rank).cast("int")
    pairs = pairs.filter(F.least(F.col("size") - F.col("place"), F.size("found") - here + 1) + F.least(
        F.col("place"), here - 1) >= F.col("need"))
    common = F.array_intersect("ranks", "found")
    pairs = pairs.withColumn("common", common).filter(
        (F.size("common") >= F.col("need")) & (F.element_at("common", 1) == rank))
    length = F.size("phrase")
    candidates = F.sequence(F.lit(1), F.size("text") - length + 1)
    consecutive = F.filter(candidates, lambda i: F.slice("text", i, length) == F.col("phrase"))
    consecutive = F.when(F.col("phrase").isNotNull() & (F.size("text") >= length),
                         F.transform(consecutive, lambda i: F.col("block") * step + i - 1))
    return pairs.select("key", "block", "template", (F.size("common") / F.col("size")).alias("score"),
                        consecutive.alias("starts"))


def license_table(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words and no labels. `score` is the largest containment over all blocks and
    templates that count: a phrase counts only where its words stand consecutively. Repeated rows are judged alike.
    """
    keyed = docs.select(row_key(["doc_id", "text"]).alias("key"), "doc_id", "text")
    found = hits(keyed, templates, threshold)
    exact = [t.exact for t in templates]
    is_exact = F.element_at(F.array(*[F.lit(e) for e in exact]), F.col("template") + 1)
    label = F.element_at(F.array(*[F.lit(t.label) for t in templates]), F.col("template") + 1)
    counted = found.withColumn("exact", is_exact).withColumn("label", label)
    counted = counted.filter(~F.col("exact") | (F.size("starts") > 0))
    # The overlap of two blocks names a place twice.
    place = F.transform(F.coalesce("starts", F.array().cast("array<bigint>")), lambda s: F.struct(
        s.alias("start"), F.col("template").alias("template")))
    per_doc = counted.groupBy("key").agg(
        F.array_distinct(F.flatten(F.collect_list(place))).alias("places"),
        F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base"),
        F.sort_array(F.collect_set("label")).alias("every"), F.max("score").alias("score"))
    count = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    # Equal rows meet as one with a count, and unfold after the join.
    rows = keyed.select("key", "doc_id", count.alias("n_words")).groupBy("key", "doc_id", "n_words").agg(
        F.count(F.lit(1)).alias("repeats"))
    joined = unfolded(rows.join(per_doc, "key", "left"), "repeats")
    return joined.select(
        "doc_id", "n_words",
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min("places")["start"].cast("bigint").alias("first_word"),
        F.array_max("places")["start"].cast("bigint").alias("last_word"),
        F.coalesce(F.array_join("base", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("every", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
