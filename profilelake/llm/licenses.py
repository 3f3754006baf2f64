"""License phrases, and text blocks that hold a license notice.

The base scan counts places where a phrase's words stand one after another. The
method is an exact set-similarity join of text blocks with notice templates.
Blocks are lines, and paragraphs of several lines, as notices are often wrapped:
lines without a word, such as blank ones or a lone comment mark, part paragraphs.
A pair matches if the block holds at least ``containment`` of the
template's distinct words. Tokens are ordered by their frequency over all lines
of the corpus, rarest first; then

* prefix filter: of ``n`` template tokens of which ``need`` must be shared, one
  of the ``n - need + 1`` rarest must be in the block's own prefix;
* length filter: the block needs at least ``need`` tokens of the templates;
* positional filter: from the first shared token, enough tokens must follow on
  both sides;
* what is left is counted exactly.

None of the filters loses a match. The templates are a fixed, short list, so they
are literals of the plan and the join needs no shuffle.

Cases: null and empty texts have no words, places or labels and score 0; rows are
judged alone and whole, so repeated rows give repeated results. The score is the
largest containment of a matching template, 1 where a base phrase stands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import texts

# What parts words, and the base phrases with their labels.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices and the labels that they give.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed "
               "under the License is distributed on an AS IS basis, without warranties or "
               "conditions of any kind"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International "
              "License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, "
            "v. 2.0"),
)

CONTAINMENT = 0.9


def lowered(text: Column) -> Column:
    """A to Z in lower case; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def words(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, BREAK), "")


def places(words: Column) -> Column:
    """``array<struct<at,label>>`` of the base phrases' places, in order."""

    def label(word: Column, i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, name in PHRASES:
            first, *rest = phrase.split(" ")
            here = word == first
            for k, other in enumerate(rest, 1):
                here = here & (F.get(words, i + k) == other)
            found = F.when(here, F.lit(name)).otherwise(found)
        return found

    firsts = F.array(*(F.lit(p.split(" ")[0]) for p, _ in PHRASES))
    none = F.array().cast("array<struct<at:int,label:string>>")
    marked = F.transform(
        words, lambda w, i: F.struct(i.alias("at"), label(w, i).alias("label"))
    )
    return F.when(
        F.arrays_overlap(words, firsts), F.filter(marked, lambda x: x["label"].isNotNull())
    ).otherwise(none)


def template_tokens() -> list[tuple[str, list[str]]]:
    """Labels and sorted distinct words of the templates, cut as the texts are."""
    import re

    cut = re.compile(BREAK)
    return [(label, sorted({w for w in cut.split(t.lower()) if w})) for label, t in TEMPLATES]


def frequency_order(documents: DataFrame) -> list[str]:
    """The templates' tokens, rarest first over all lines of all documents.

    Counts per token come back: as many numbers as the templates have words.
    """
    vocabulary = sorted({w for _, tokens in template_tokens() for w in tokens})
    known = F.array(*map(F.lit, vocabulary))
    blocks = texts(documents).select(F.split(lowered(F.col("text")), "\n").alias("blocks"))
    tokens = blocks.select(
        F.flatten(
            F.transform("blocks", lambda b: F.array_intersect(F.split(b, BREAK), known))
        ).alias("tokens")
    )
    rows = (
        tokens.select(F.explode_outer("tokens").alias("token"))
        .filter(F.col("token").isNotNull())
        .groupBy("token")
        .count()
        .collect()
    )
    counts = {row["token"]: row["count"] for row in rows}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def block_matches(text: Column, order: list[str], containment: float) -> Column:
    """``array<struct<label,score>>`` of all (block, template) pairs that match."""
    rank = {w: i for i, w in enumerate(order)}
    templates = []
    for label, tokens in template_tokens():
        need = max(1, math.ceil(containment * len(tokens) - 1e-9))
        templates.append((label, sorted(tokens, key=rank.__getitem__), need))
    rare = sorted({w for _, tokens, need in templates for w in tokens[: len(tokens) - need + 1]})
    known, rare = F.array(*map(F.lit, order)), F.array(*map(F.lit, rare))

    def pair(block: Column, label: str, tokens: list[str], need: int) -> Column:
        all_ = F.array(*map(F.lit, tokens))
        prefix = F.array(*map(F.lit, tokens[: len(tokens) - need + 1]))
        own = F.slice(block, 1, F.greatest(F.size(block) - (need - 1), F.lit(0)))
        shared = F.array_intersect(block, all_)
        first = F.get(shared, F.lit(0))
        after = F.least(
            len(tokens) - F.array_position(all_, first), F.size(block) - F.array_position(block, first)
        )
        matches = (
            (F.size(block) >= need)
            & F.arrays_overlap(own, prefix)
            & (after + 1 >= need)
            & (F.size(shared) >= need)
        )
        found = F.struct(
            F.lit(label).alias("label"), (F.size(shared) / F.lit(len(tokens))).alias("score")
        )
        return F.when(matches, found)

    # array_intersect keeps the order of its first side: a block's tokens, rarest first.
    paragraphs = F.filter(F.split(text, GAP), lambda p: F.contains(p, F.lit("\n")))
    blocks = F.transform(
        F.concat(F.split(text, "\n"), paragraphs),
        lambda b: F.array_intersect(known, F.split(b, BREAK)),
    )
    candidates = F.filter(blocks, lambda b: F.arrays_overlap(b, rare))
    return F.flatten(
        F.transform(
            candidates,
            lambda b: F.filter(
                F.array(*(pair(b, *t) for t in templates)), lambda x: x.isNotNull()
            ),
        )
    ), rare


def scan(documents: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: words, base places and labels, all labels, score."""
    matches, rare = block_matches(F.col("lowered"), frequency_order(documents), containment)
    none = F.array().cast("array<struct<label:string,score:double>>")
    found = (
        texts(documents)
        .withColumn("lowered", lowered(F.col("text")))
        .withColumn("words", words(F.col("lowered")))
        .select(
            "doc_id",
            F.size("words").cast("bigint").alias("n_words"),
            places(F.col("words")).alias("places"),
            F.when(F.arrays_overlap("words", rare), matches).otherwise(none).alias("matches"),
        )
    )
    at = F.transform("places", lambda p: p["at"].cast("bigint"))
    base = F.transform("places", lambda p: p["label"])
    every = F.concat(base, F.transform("matches", lambda m: m["label"]))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )
