"""License scan by an exact set-similarity join of text blocks with license templates.

A block matches a template if it holds at least a given share of the template's distinct words.
The words of all templates are ordered by document frequency, the rarest first.  If a block
matches, the first few words of both in this order (the prefixes) have one in common; joining on
these finds every match.  Length and positional filters drop pairs before sets are compared.
Only built-in functions run on the executors.
"""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose places are counted, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Sentences by which licenses are told.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis, without warranties or conditions of any kind"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License"),
    ("agpl", "You can redistribute it under the terms of the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This source code form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial license"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike license"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Share of a template's distinct words that a block must hold.
CONTAINMENT = 0.8
#: Least words of a block, and from one block to the next (see `block_words`).
BLOCK, STRIDE = 64, 32
#: Templates are small by nature; their words go to every executor.
MAX_TEMPLATE_WORDS = 20_000


def words(text: Column) -> Column:
    """Words of the text after lower-casing A-Z.

    `lower` also changes other letters, which moves no word border and turns only the Kelvin sign
    into a letter of A-Z; that sign is replaced first.
    """
    return F.regexp_extract_all(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ"))), F.lit(WORD), 0)


def _texts(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def block_words(templates: tuple[tuple[str, str], ...]) -> tuple[int, int]:
    """Words of a block, and from one block to the next.

    Blocks begin at least as far apart as the longest template is long and overlap by half, so every
    place of a template, whole or with a word more than it, lies within one block.
    """
    stride = max([STRIDE, *(len(re.findall(WORD, text.lower())) for _, text in templates)])
    return max(BLOCK, 2 * stride), stride


def places(column: str, phrase: str) -> Column:
    """Starts of the places where the words of the phrase stand consecutively, words from 0."""
    parts, all_words = phrase.split(" "), F.col(column)
    there = F.size(all_words) >= len(parts)
    for part in parts:
        there = there & F.array_contains(all_words, part)

    def begins(i: Column) -> Column:
        fits = F.lit(True)
        for k, part in enumerate(parts):
            fits = fits & (F.get(all_words, i + k) == part)
        return fits

    found = F.filter(F.sequence(F.lit(0), F.greatest(F.size(all_words) - len(parts), F.lit(0))), begins)
    return F.when(there, found).otherwise(F.array().cast("array<int>"))


def word_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary by the number of rows of `docs` that have the word, the rarest first."""
    seen = docs.select(F.explode(F.array_intersect(words(F.col("text")), _texts(vocabulary))).alias("word")).groupBy("word").count()
    count = dict(seen.collect())  # at most one row for each word of the vocabulary
    return sorted(vocabulary, key=lambda w: (count.get(w, 0), w))


def prefix_index(templates: tuple[tuple[str, str], ...], sets: list[list[str]], order: list[str], containment: float) -> list[Column]:
    """An entry for each word in the prefix of each template: the words of a template in the given order,
    of which a matching block must hold the first, or the second, and so on up to the last of these."""
    rank, entries = {w: k for k, w in enumerate(order)}, []
    for number, ((label, _), members) in enumerate(zip(templates, sets, strict=True)):
        ranks = sorted(rank[w] for w in members)
        need = max(1, ceil(containment * len(ranks)))
        for i, r in enumerate(ranks[: len(ranks) - need + 1]):
            fields = {"token": r, "i": i, "size": len(ranks), "need": need, "template": number, "label": label}
            entries.append(F.struct(*(F.lit(v).alias(k) for k, v in fields.items()), F.array(*map(F.lit, ranks)).alias("ranks")))
    return entries


def _probed(docs: DataFrame, templates: tuple[tuple[str, str], ...], containment: float) -> DataFrame:
    """Each row of `docs` under an id, with its counts and places, once for each candidate pair of one of
    its blocks and a template (and once if there is none); containment is null for a pair below the threshold."""
    spark = docs.sparkSession
    length, stride = block_words(templates)
    sets = [sorted(set(re.findall(WORD, text.lower()))) for _, text in templates]
    vocabulary = sorted(set().union(*sets))
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"the templates have more than {MAX_TEMPLATE_WORDS} distinct words")
    order = word_order(docs, vocabulary)
    rank = {w: k for k, w in enumerate(order)}
    needs = [max(1, ceil(containment * len(s))) for s in sets]
    least = min(needs)
    prefix_words = {w for s, need in zip(sets, needs, strict=True) for w in sorted(s, key=rank.get)[: len(s) - need + 1]}
    index = spark.range(1).select(F.inline(F.array(*prefix_index(templates, sets, order, containment))))
    ranked = F.create_map(*(F.lit(x) for w in order for x in (w, rank[w])))

    def known(start: Column) -> Column:
        """Ranks of the template words of a block, ascending; other words come last in the order and match nothing."""
        block = F.array_intersect(F.slice("w", start + 1, length), _texts(vocabulary))
        return F.array_sort(F.transform(block, lambda x: F.element_at(ranked, x)))

    rows = docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(stride))
    blocks = F.when(F.arrays_overlap("w", _texts(sorted(prefix_words))), F.transform(starts, known))
    spots = [places("w", phrase).alias(f"at_{label}") for phrase, label in PHRASES]
    rows = rows.select("id", "doc_id", F.size("w").cast("bigint").alias("n_words"), *spots, blocks.alias("blocks"))
    rows = rows.select("*", F.posexplode_outer("blocks").alias("block", "v")).drop("blocks")
    heads = F.when(F.size("v") >= least, F.slice("v", F.lit(1), F.size("v") - least + 1))
    probes = rows.select("*", F.posexplode_outer(heads).alias("j", "word"))
    fits = (
        (F.col("word") == F.col("token"))
        & (F.size("v") >= F.col("need"))  # length
        & (F.col("j") <= F.size("v") - F.col("need"))  # prefix of the block for this template
        & (1 + F.least(F.col("size") - F.col("i") - 1, F.size("v") - F.col("j") - 1) >= F.col("need"))  # position
    )
    pairs = probes.join(F.broadcast(index), fits, "left")
    held = F.size(F.array_intersect("v", "ranks"))
    return pairs.withColumn("containment", F.when(held >= F.col("need"), held / F.col("size")))


def template_matches(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, block (its number), template (its number), label and containment of every match, once for each row of `docs`.

    Blocks are those of `block_words`, over the whole text however long.  Null and empty texts match
    nothing; of ties nothing is dropped: a block may match several templates, and a place in the half
    that two blocks share matches in both.  Repeated rows match one by one; an empty table gives an
    empty table; columns other than doc_id and text are not read.
    """
    found = _probed(docs.select("doc_id", "text"), templates, containment).where("containment IS NOT NULL")
    return found.select("id", "doc_id", "block", "template", "label", "containment").distinct().drop("id")


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """For each row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of PHRASES; first_word and last_word are their smallest and largest
    start, null without any.  labels adds the labels of matching templates.  score is the largest
    containment of a matching template, 1 where a phrase stands, else 0.  Null and empty texts have
    no words; very long texts are cut into blocks (`block_words`), none is left out; repeated rows
    are scanned one by one; columns other than doc_id and text are not read.
    """
    every = F.concat(*(F.col(f"at_{label}") for _, label in PHRASES))
    named = F.array_compact(F.array(*(F.when(F.size(f"at_{label}") > 0, label) for _, label in PHRASES)))
    probed = _probed(docs.select("doc_id", "text"), templates, containment)
    rows = probed.select(
        "id", "doc_id", "n_words", F.size(every).cast("bigint").alias("n_base"),
        F.array_min(every).cast("bigint").alias("first_word"), F.array_max(every).cast("bigint").alias("last_word"),
        F.array_sort(named).alias("base"), F.when(F.col("containment").isNotNull(), F.col("label")).alias("label"), "containment",
    )
    kept = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base")
    whole = rows.groupBy("id").agg(
        *(F.first(c).alias(c) for c in kept), F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    return whole.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union("base", "more")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
