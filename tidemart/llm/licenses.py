"""License scans: an exact set-similarity join of text blocks with license templates.

Native throughout. Tokens are ordered by how many documents hold them, rarest first. A block holds
a template if it has at least o of the template's n distinct words. Then one of the n - o + 1
rarest words of the template is in the block (prefix filter), the block has at least o of the words
(length filter), and behind the first common word both have enough words left (positional filter).
Texts become words once: what is kept of them are the places of words that templates have.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shared import saved

WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
STRIDE = 32     # blocks are two strides wide, so any stride + 1 words in a row lie in one block
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """`phrase`: the words must also stand one after another; only such matches count as base."""
    label: str
    text: str
    threshold: float = 0.8
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def needed(self) -> int:
        return max(1, math.ceil(self.threshold * len(set(self.words)) - 1e-9))

    @property
    def stride(self) -> int:
        """Of the blocks that are compared with this template: STRIDE, doubled until it fits."""
        return STRIDE << max(0, math.ceil(math.log2(max(1, len(self.words) - 1) / STRIDE)))


# fixed values: the phrases that a scan must find, and the usual notices
TEMPLATES = (
    Template("mit", "mit license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
                    "this software and associated documentation files"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("apache", "you may not use this file except in compliance with the license"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under "
                    "the terms of the gnu general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification "
                    "are permitted provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc", "licensed under cc by nc 4 0"),
    Template("cc", "this work is licensed under a creative commons attribution license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
                    "this software and associated documentation files the software to deal in the "
                    "software without restriction including without limitation the rights to use "
                    "copy modify merge publish distribute sublicense and or sell copies of the "
                    "software and to permit persons to whom the software is furnished to do so "
                    "subject to the following conditions the above copyright notice and this "
                    "permission notice shall be included in all copies or substantial portions of "
                    "the software the software is provided as is without warranty of any kind "
                    "express or implied including but not limited to the warranties of "
                    "merchantability fitness for a particular purpose and noninfringement in no "
                    "event shall the authors or copyright holders be liable for any claim damages "
                    "or other liability whether in an action of contract tort or otherwise arising "
                    "from out of or in connection with the software or the use or other dealings "
                    "in the software"),
)


def words(text: str) -> Column:
    """Words of a text as they are written; none for null."""
    return F.regexp_extract_all(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD), F.lit(0))


def _low(word: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, LOWER))


def _literals(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def facts(documents: DataFrame, text: str, keep: tuple[str, ...], vocabulary: list[str]) -> DataFrame:
    """(__row, k_<keep>, n_words, facts): places p, from 0, of the words t in `vocabulary`."""
    def fact(word: Column, p: Column) -> Column:
        return F.when(_low(word).isin(vocabulary), F.struct(p.alias("p"), _low(word).alias("t")))

    rows = documents.select(F.monotonically_increasing_id().alias("__row"),
                            *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep], words(text).alias("w"))
    return rows.select("__row", *[f"k_{c}" for c in keep], F.size("w").cast("bigint").alias("n_words"),
                       F.filter(F.transform("w", fact), lambda x: x.isNotNull()).alias("facts"))


def frequency_order(found: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary by the number of rows of `facts` that hold a word, rarest first.

    Counted over all documents; only one row per word of the vocabulary reaches the driver.
    """
    held = found.select(F.explode(F.array_distinct(F.col("facts.t"))).alias("word"))
    counts = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _blocks(stride: int, rare: list[str]) -> Column:
    """The blocks of `facts` with a word of `rare`: stride, number b, words `own` with their places.

    All words of a block stand in the facts within a block's width of a rare one of its own.
    """
    def begins(x: Column, i: Column) -> Column:
        b = F.floor(x["p"] / stride).cast("int")
        return F.when(x["t"].isin(rare), F.array(F.struct(b.alias("b"), i.alias("i")),
                                                 F.struct((b - 1).alias("b"), i.alias("i"))))

    last = F.greatest(F.lit(0), F.ceil((F.col("n_words") - stride) / stride).cast("int") - 1)
    met = F.array_sort(F.filter(F.flatten(F.filter(F.transform("facts", begins), lambda x: x.isNotNull())),
                                lambda x: (x["b"] >= 0) & (x["b"] <= last)))

    def block(x: Column) -> Column:
        near = F.slice("facts", F.greatest(F.lit(1), x["i"] + 2 - 2 * stride), F.lit(4 * stride))
        own = F.filter(near, lambda y: (y["p"] >= x["b"] * stride) & (y["p"] < (x["b"] + 2) * stride))
        return F.struct(F.lit(stride).alias("stride"), x["b"].alias("b"), own.alias("own"))

    first = F.filter(met, lambda x, i: (i == 0) | (x["b"] != F.get(met, i - 1)["b"]))
    return F.transform(first, block)


def scan(documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
         templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """`keep`, n_words, n_base, first_word, last_word, base_labels, labels, score for each row.

    n_base: places where a phrase stands; first_word, last_word: their least and largest start,
    words from 0, or null. labels: of all templates some block holds; score: the largest share
    of a template's words held by a block that holds it, or 0. Blocks are as wide as a template
    needs (`Template.stride`). A null or empty text has no words. Repeated rows give repeated results.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    found = saved(facts(documents, text, keep, vocabulary), "facts")
    order = frequency_order(found, vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    filed, prefixes = [], {}
    for t in templates:
        tokens = sorted(set(t.words), key=rank.get)
        for i, w in enumerate(tokens[:len(tokens) - t.needed + 1]):
            filed.append((t.stride, w, i, len(tokens), t.needed, tokens, t.label, t.words, t.phrase))
            prefixes.setdefault(t.stride, set()).add(w)
    index = documents.sparkSession.createDataFrame(filed, (
        "stride int, token string, i int, n int, needed int, tokens array<string>, label string, "
        "phrase array<string>, consecutive boolean"))

    kept = [f"k_{c}" for c in keep]
    blocks = [_blocks(stride, sorted(own)) for stride, own in sorted(prefixes.items())]
    rows = found.select("__row", *kept, "n_words", F.explode_outer(F.concat(*blocks)).alias("x"))
    # the words of a block in the order of their frequency, each once
    sorted_words = F.array_intersect(_literals(order), F.col("x.own.t"))
    tokens = rows.withColumn("words", sorted_words).select("*", F.posexplode_outer("words").alias("j", "token"))
    tokens = tokens.withColumn("stride", F.col("x.stride"))
    met = tokens.join(F.broadcast(index), ["stride", "token"], "left")  # as many rows as templates have words
    size = F.size("words")
    left = F.least(F.col("n") - F.col("i"), size - F.col("j"))
    overlap = F.size(F.array_intersect("words", "tokens"))
    enough = (size >= F.col("needed")) & (left >= F.col("needed")) & (overlap >= F.col("needed"))
    length = F.size("phrase")

    def stands(x: Column, i: Column) -> Column:
        """Whether the phrase stands at a place; a place belongs to the first block that holds all of it."""
        own = F.slice("x.own", i + 1, length)
        begin = x["p"] - F.col("x.b") * F.col("stride")
        return (own["t"] == F.col("phrase")) & (F.element_at(own, -1)["p"] - x["p"] == length - 1) & (
            (F.col("x.b") == 0) | (begin + length > F.col("stride")))

    places = F.when(enough & F.col("consecutive"), F.filter("x.own", stands)["p"].cast("array<bigint>"))
    met = met.select("__row", *kept, "n_words", "label", places.alias("places"),
                     F.when(enough & ~F.col("consecutive"), overlap / F.col("n")).alias("share"))
    based = F.size("places") > 0
    result = met.groupBy("__row").agg(
        *[F.first(f"k_{c}").alias(c) for c in keep], F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.when(based, F.size("places"))), F.lit(0)).cast("bigint").alias("n_base"),
        F.min(F.when(based, F.array_min("places"))).alias("first_word"),
        F.max(F.when(based, F.array_max("places"))).alias("last_word"),
        F.collect_set(F.when(based, F.col("label"))).alias("base"),
        F.collect_set(F.when(based | F.col("share").isNotNull(), F.col("label"))).alias("all"),
        F.coalesce(F.max(F.when(based, F.lit(1.0)).otherwise(F.col("share"))), F.lit(0.0))
        .alias("score"))
    return result.select(*keep, "n_words", "n_base", "first_word", "last_word",
                         F.array_join(F.array_sort("base"), ",").alias("base_labels"),
                         F.array_join(F.array_sort("all"), ",").alias("labels"), "score")
