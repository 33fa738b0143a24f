"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of words, its tokens are the runs of ``RUN`` words in it; it matches a template if
it holds at least ``CONTAINMENT`` of the template's distinct tokens, ``need`` of them. A word put in or
changed inside a notice breaks two or three tokens, so a template of nine tokens or fewer is not taken
for a sister's notice that differs by one word. Tokens outside all templates can't count, so blocks are
sets over the templates' tokens. Tokens are ordered by how many blocks of the whole corpus hold them,
rarest first. Two sets that share ``need`` tokens share one within their prefixes: the first
|t| - need + 1 tokens of the template and |b| - need + 1 of the block. They are joined on those tokens
only, and a pair is dropped where the block has too few tokens (length filter) or too few are left from
the common token on (positional filter). What remains is compared in full.

All steps are column expressions and joins.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, stage

#: Words of a block, and how far the next one starts.
BLOCK_WORDS, BLOCK_STEP = 64, 32
#: Words of a token.
RUN = 3
#: Share of a template's distinct tokens that a block must hold.
CONTAINMENT = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases with their labels, and license notices as the method's templates.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "agpl-notice": "licensed under the GNU Affero General Public License version 3",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-notice": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "gpl-notice": "licensed under the GNU General Public License, version 3",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "proprietary-notice": "All rights reserved. No part may be reproduced without prior written permission",
}
# end of fixed values


def words_in(text: Column) -> Column:
    """The words of a whole text, A-Z lower-cased; none for a null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def tokens_of(words: Column) -> Column:
    """Each run of RUN words, joined by blanks; after them a null for each word that begins none."""
    runs = words
    for k in range(1, RUN):
        runs = F.zip_with(runs, F.slice(words, F.lit(k + 1), F.size(words)), lambda x, y: F.concat(x, F.lit(" "), y))
    return runs


def template_tokens(spark: SparkSession, templates: Mapping[str, str]) -> dict[str, list[str]]:
    """The distinct tokens of each template, by the same rule as those of texts."""
    if not templates:
        return {}
    rows = F.explode(F.create_map(*[F.lit(x) for pair in sorted(templates.items()) for x in pair])).alias("name", "text")
    tokens = F.array_sort(F.array_distinct(F.array_compact(tokens_of(words_in(F.col("text"))))))
    found = {r["name"]: list(r.tokens) for r in spark.range(1).select(rows).select("name", tokens.alias("tokens")).collect()}
    if short := [name for name, tokens in found.items() if not tokens]:
        raise ValueError(f"templates of fewer than {RUN} words: {short}")
    return found


def phrase_places(words: Column, phrase: list[str]) -> Column:
    """The starts of a phrase in an array of words. Only texts that hold its last word are searched."""
    consecutive = lambda i: _all([F.get(words, i + k) == w for k, w in enumerate(phrase)])
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), consecutive)
    return F.when(F.array_contains(words, phrase[-1]) & F.array_contains(words, phrase[0]), places).otherwise(F.array().cast("array<int>"))


def _all(conditions: list[Column]) -> Column:
    held = conditions[0]
    for c in conditions[1:]:
        held = held & c
    return held


def scanned(docs: DataFrame, key: str, text: str, phrases: Mapping[str, str], vocabulary: list[str]) -> DataFrame:
    """One staged row per document, numbered: its count of words, the places of the phrases, and the
    vocabulary's tokens in each block that has any."""
    split = docs.select(quoted(key).alias("key"), words_in(quoted(text)).alias("words"))
    words = F.col("words")
    known = F.array(*[F.lit(w) for w in vocabulary])
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (BLOCK_WORDS - BLOCK_STEP), F.lit(1)), F.lit(BLOCK_STEP))
    blocks = F.transform(starts, lambda at: F.array_intersect(tokens_of(F.slice(words, at, BLOCK_WORDS)), known))
    blocks = F.filter(blocks, lambda b: F.size(b) > 0) if vocabulary else F.array().cast("array<array<string>>")
    places = [phrase_places(words, p.split()).alias(f"p{i}") for i, p in enumerate(phrases)]
    rows = split.select("key", F.size(words).cast("bigint").alias("n_words"), *places, blocks.alias("blocks"))
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "license-blocks")


def matches(rows: DataFrame, templates: Mapping[str, list[str]], containment: float) -> DataFrame:
    """(row, name, share) for every block and template that meet the threshold."""
    counted = rows.select(F.explode("blocks").alias("block")).select(F.explode("block").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    seen = {r.word: r.n for r in counted.collect()}  # at most the templates' tokens
    order = sorted({w for t in templates.values() for w in t}, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    needs = {name: ceil(containment * len(words) - 1e-9) for name, words in templates.items()}
    sides = []
    for name, words in templates.items():
        ranks = sorted(rank[w] for w in words)
        for place in range(len(ranks) - needs[name] + 1):
            whole = F.array(*[F.lit(r) for r in ranks])
            sides.append(F.struct(F.lit(ranks[place]).alias("word"), F.lit(place).alias("t_place"), F.lit(name).alias("name"), F.lit(needs[name]).alias("need"), whole.alias("t")))
    side = rows.sparkSession.range(1).select(F.inline(F.array(*sides)))  # prefix tokens of the templates
    least = min(needs.values())
    numbers = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    long_enough = F.explode(F.filter("blocks", lambda b: F.size(b) >= least))
    blocks = rows.select("row", long_enough.alias("b")).select("row", F.array_sort(F.transform("b", lambda w: F.element_at(numbers, w))).alias("b"))
    prefix = F.slice("b", F.lit(1), F.size("b") - (least - 1))
    probes = blocks.select("row", "b", F.posexplode(prefix).alias("b_place", "word"))
    met = probes.join(F.broadcast(side), "word")
    long = F.size("b") >= F.col("need")
    enough_left = F.least(F.size("b") - F.col("b_place"), F.size("t") - F.col("t_place")) >= F.col("need")
    shared = F.size(F.array_intersect("b", "t"))
    compared = met.where(long & enough_left).select("row", "name", "need", shared.alias("shared"), F.size("t").alias("n"))
    return compared.where(F.col("shared") >= F.col("need")).select("row", "name", (F.col("shared") / F.col("n")).alias("share"))


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document: ``key``, n_words, n_base (places of all phrases), first_word and last_word
    (their smallest and largest start, counted in words from 0; else null), base_labels and labels (the
    templates' names too; both distinct, sorted and comma-joined) and score (1 where a phrase stands, else
    the largest share of a matching template, else 0).

    Null and empty texts have no words; very long texts are cut into blocks from end to end. Repeated
    rows give a row each, an empty table gives an empty one. Other columns are not read.
    """
    if not 0 < containment <= 1:
        raise ValueError("containment lies above 0 and at most at 1")
    known = template_tokens(docs.sparkSession, templates)
    rows = scanned(docs, key, text, phrases, sorted({w for t in known.values() for w in t}))
    places = F.concat(F.array().cast("array<int>"), *[F.col(f"p{i}") for i in range(len(phrases))])
    own = [F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*own)))) if own else F.array().cast("array<string>")
    out = rows.select("row", "key", "n_words", places.alias("places"), base.alias("base"))
    if known:
        found = matches(rows, known, containment).groupBy("row").agg(F.collect_set("name").alias("names"), F.max("share").alias("share"))
        out = out.join(found, "row", "left")
    else:
        out = out.withColumns({"names": F.array().cast("array<string>"), "share": F.lit(None).cast("double")})
    every = F.array_sort(F.array_union("base", F.coalesce("names", F.array().cast("array<string>"))))
    return out.select(
        F.col("key").alias(key),
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").cast("bigint").alias("first_word"),
        F.array_max("places").cast("bigint").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
