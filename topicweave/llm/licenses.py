"""License scan: an exact set-similarity join of text blocks with license templates.

A template is the set of words of a notice.  A text is cut into overlapping blocks of
words, so long that every run as long as the longest template lies in one.  A block
matches when it holds at least the threshold's share of the template's words.

Words are ordered by how often they occur in all texts, the rarest first.  A block that
shares enough words with a template shares one of the template's first few, which
are a list of entries to join with (prefix filter); it must hold enough words at
all (length filter), and the shared word must not stand so late in either order
that too few can follow (position filter).  What is left is verified.  Fixed
phrases are templates that must be there whole, and the places where their words
follow each other are then read off the block.

Only words that occur in a template can be shared, so a text is read once and
reduced to the places of those words.  Everything is DataFrame expressions.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.exact import normalised
from topicweave.scratch import Scratch

# fixed values: the phrases asked for, and sentences of public licenses
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-nc", "Licensed under CC BY-NC 4.0"),
    ("gnu", "This work is licensed under the GNU General Public License, version 3"),
    ("gnu", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mozilla", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text in order; only A-Z are lower-cased."""
    return F.array_remove(F.split(normalised(text), BETWEEN, -1), "")


def plain_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


class Template:
    """A template's words by rank, and how many of them a block must hold."""

    def __init__(self, number: int, label: str, text: str, phrase: bool, threshold: float, rank: dict[str, int]):
        self.number, self.label, self.phrase = number, label, phrase
        self.sequence = [rank[w] for w in plain_words(text)]
        self.tokens = sorted(set(self.sequence))
        self.least = len(self.tokens) if phrase else math.ceil(threshold * len(self.tokens) - 1e-9)
        self.prefix = self.tokens[: len(self.tokens) - self.least + 1]

    def entries(self) -> list[Column]:
        """One row for each word of the prefix."""
        return [
            F.struct(
                F.lit(token).alias("token"), F.lit(i).alias("at_template"), F.lit(self.number).alias("template"),
                F.lit(self.label).alias("label"), F.lit(self.phrase).alias("phrase"), F.lit(self.least).alias("least"),
                F.array(*map(F.lit, self.tokens)).alias("theirs"), F.array(*map(F.lit, self.sequence)).alias("sequence"),
            )
            for i, token in enumerate(self.prefix)
        ]


def scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: list[tuple[str, str]] = PHRASES,
    threshold: float = 0.8,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row.

    ``labels`` are those of the phrases and of the templates found; ``score`` is 1
    where a phrase stands and else the largest share of a template found in one
    block, 0 without any.  A null or empty text has no words, null places and empty
    labels.  Rows that repeat an id or a text stay apart.  Words equally frequent are
    ordered by themselves, which changes no result.  An empty table gives no rows.
    Bound: the words of all templates go into the plan as literals and to the driver
    with their counts.
    """
    scratch = Scratch(docs.sparkSession, "licenses")
    spark = docs.sparkSession
    wanted = [(label, text, True) for label, text in phrases] + [(label, text, False) for label, text in templates]
    wanted = [w for w in wanted if plain_words(w[1])]
    known = sorted({w for _, text, _ in wanted for w in plain_words(text)})
    stride = max([len(plain_words(text)) for _, text, _ in wanted], default=1)

    at_word = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    read = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    read = read.select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"), F.filter(at_word, lambda x: x["word"].isin(known)).alias("hits")
    )
    read = scratch.table(read, "read")

    # the global order: rarest first, over all texts
    counted = read.select(F.explode("hits.word").alias("word")).groupBy("word").count().collect()
    count = {row["word"]: row["count"] for row in counted}
    order = sorted(known, key=lambda w: (count.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = [Template(i, *w, threshold, rank) for i, w in enumerate(wanted)]
    entries = [e for t in index for e in t.entries()]
    none = read.select("row", F.lit(0).cast("long").alias("n_base")).limit(0)
    if entries:
        found = _found(spark, read, order, index, entries, stride)
    else:
        found = none.selectExpr("row", "n_base", "0L AS first_word", "0L AS last_word", "array('') AS base", "array('') AS own", "0D AS share")
    empty = F.array().cast("array<string>")
    base, own = F.coalesce("base", empty), F.coalesce("own", empty)
    n_base = F.coalesce("n_base", F.lit(0).cast("long"))
    return read.join(found, "row", "left").select(
        "doc_id", "n_words", n_base.alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _found(spark, read: DataFrame, order: list[str], index: list[Template], entries: list[Column], stride: int) -> DataFrame:
    """What the join finds for each row with a match: places of phrases, labels, and the largest share."""
    one = spark.range(1)
    entry = F.broadcast(one.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))  # literals: the templates
    ranks = F.broadcast(one.select(F.posexplode(F.array(*map(F.lit, order))).alias("token", "word")))
    telling = sorted({order[token] for t in index for token in t.prefix})
    near = read.where(F.arrays_overlap("hits.word", F.array(*map(F.lit, telling)))).select("row", F.explode("hits").alias("h"))
    hits = near.select("row", "h.*").join(ranks, "word")

    # a word lies in the block that starts in its stride and in the one before
    here = F.floor(F.col("at") / stride).cast("int")
    blocks = hits.select("row", "at", "token", F.explode(F.array(here, here - 1)).alias("block")).where("block >= 0")
    blocks = blocks.groupBy("row", "block").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("held"))
    blocks = blocks.withColumn("ours", F.array_sort(F.array_distinct("held.token")))
    least = min(t.least for t in index)
    size = F.size("ours")
    prefix = F.slice("ours", 1, F.greatest(size - least + 1, F.lit(0)))
    probe = blocks.where(size >= least).select("row", "block", "held", "ours", F.posexplode(prefix).alias("at_block", "token"))

    after = F.least(F.size("theirs") - F.col("at_template"), size - F.col("at_block"))
    pairs = probe.join(entry, "token").where((size >= F.col("least")) & (after >= F.col("least")))
    pairs = pairs.withColumn("shared", F.array_intersect("ours", "theirs"))
    # the first shared word speaks for the pair
    first = F.element_at("shared", 1) == F.col("token")
    pairs = pairs.where((F.size("shared") >= F.col("least")) & first)

    def follows(h: Column) -> Column:
        starts = (F.floor(h["at"] / stride) == F.col("block")) & (h["token"] == F.element_at("sequence", 1))
        return starts & F.forall(
            F.transform("sequence", lambda token, k: F.struct((h["at"] + k).cast("int").alias("at"), token.alias("token"))),
            lambda x: F.array_contains("held", x),
        )

    places = F.transform(F.filter("held", follows), lambda h: h["at"])
    pairs = pairs.withColumn("places", F.when(F.col("phrase"), places))
    stands = F.col("phrase") & (F.size("places") > 0)
    return pairs.groupBy("row").agg(
        F.coalesce(F.sum(F.when(stands, F.size("places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.array_min("places")).cast("long").alias("first_word"),
        F.max(F.array_max("places")).cast("long").alias("last_word"),
        F.collect_set(F.when(stands, F.col("label"))).alias("base"),
        F.collect_set(F.when(~F.col("phrase"), F.col("label"))).alias("own"),
        F.max(F.when(~F.col("phrase"), F.size("shared") / F.size("theirs"))).alias("share"),
    )
