"""Licence scanning with SQL functions only.

Words are letters and digits, lower-cased; a shingle is two words.  A template is
cut into overlapping pieces of at most 9 words and a text into windows of 16 words
every 8, so each piece of a copied template lies whole inside a window.  Each piece
and each window has 40 universal hash minima, one to a band: a piece of s shingles
inside a window of 15 shares a band with probability 1 - (1 - s/15)^40, which is
0.99999 for the shortest pieces (4 shingles).  Windows with fewer than two template
shingles hold no piece and are left out beforehand.  A retrieved template is
verified by exact containment: the part of its shingles found in the words around
the window, as many on either side as the template has.

The library's shingles and band keys are written tables of any size, joined without a hint.
Before the joins, a table of bits (1 MB at most) tells which shingles and keys may be in
them; what it lets through by chance, more with a very large library, the joins remove.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import materialize

WINDOW = 16
STRIDE = 8
PIECE = WINDOW - STRIDE + 1
BANDS = 40
MAX_BITS = 23            # bits of a table of bits: 1 MB

# Public licence notices.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; a text without any has none."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def shingles(word_array: str) -> Column:
    """Hashes of neighbouring pairs of the words in a column; a lone word is paired with null."""
    w = F.col(word_array)
    pairs = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1)))
    return F.when(F.size(w) > 1, F.slice(pairs, 1, F.greatest(F.size(w) - 1, F.lit(1)))).otherwise(pairs)


def band_keys(hashes: Column) -> Column:
    """One key for each band: a universal hash family's minimum over the shingles, with the band's number mixed in."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)),
                       lambda i: F.xxhash64(i, F.array_min(F.transform(hashes, lambda x: F.xxhash64(i, x)))))


def template_table(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """(template, licence, text's shingles, number of words) of each template; templates without a word are left out."""
    rows = [(i, name, text) for i, (name, text) in enumerate((n, t) for n, ts in templates.items() for t in ts)]
    t = spark.createDataFrame(rows, "template int, licence string, text string").withColumn("w", words(F.col("text")))
    return t.where(F.size("w") > 0).select("template", "licence", "w", F.array_distinct(shingles("w")).alias("wanted"), shingles("w").alias("sh"))


def _member(values: DataFrame, name: str) -> Callable[[Column], Column]:
    """A test that holds for every hash in the column ``name``, and by chance for a few others."""
    size = min(MAX_BITS, max(10, (32 * values.count()).bit_length()))
    at = F.shiftrightunsigned(F.col(name), 64 - size)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    bits = [0] * (1 << (size - 6))
    for r in values.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).collect():
        bits[r["at"]] = r["bits"]
    table = F.from_json(F.lit(json.dumps(bits)), "array<bigint>")        # folded to a literal

    def test(x: Column) -> Column:
        p = F.shiftrightunsigned(x, 64 - size)
        own = F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(F.lit(63)).cast("int"))
        return F.get(table, F.shiftright(p, 6).cast("int")).bitwiseAND(own) != 0

    return test


def _windows() -> Column:
    """Starts of the windows that hold two neighbouring ``hits`` (places of template shingles in ascending order)."""
    def of(i, k):
        nxt = F.get(F.col("hits"), k + 1)
        first = (F.floor(i / STRIDE) * STRIDE).cast("int")
        return F.filter(F.array(first, first - STRIDE), lambda s: (s >= 0) & (nxt <= s + WINDOW - 2))

    return F.array_distinct(F.flatten(F.transform("hits", of)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None,
         threshold: float = 0.8) -> DataFrame:
    """One row per (row of ``docs``, licence) found: id, licence, containment, first_word, n_windows.

    containment is the best template's exact share of distinct shingles found around
    a retrieved window (at least ``threshold``), first_word the first window's place
    in words, n_windows the windows that verified.  Null, empty and word-free texts
    find nothing; repeated rows are found each by itself; other columns are ignored.
    ``templates`` maps a licence to its notices, any number of them; a one-word template
    must occur as a lone text.  A retrieved window carries the template shingles of as many
    words around it as the longest template has.
    """
    spark = docs.sparkSession
    known = materialize(template_table(spark, templates or TEMPLATES), "licence-templates")
    pieces = known.select("template", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("sh") - (PIECE - 2), F.lit(1)), F.lit(PIECE // 2)),
        lambda s: F.slice("sh", s, PIECE - 1))).alias("piece"))
    last = known.select("template", F.slice("sh", F.greatest(F.size("sh") - (PIECE - 2), F.lit(1)), PIECE - 1).alias("piece"))
    retrieve = pieces.unionAll(last).distinct()
    keys = materialize(retrieve.select("template", F.explode(band_keys(F.col("piece"))).alias("key")).distinct(), "licence-keys")
    of_template = _member(known.select(F.explode("wanted").alias("x")).distinct(), "x")
    of_piece = _member(keys.select("key").distinct(), "key")
    longest = known.agg(F.max(F.size("w"))).first()[0] or 0

    reach = longest + WINDOW
    # arrays that a lambda reads are columns used twice, so that they are computed once for a text
    text = docs.select(F.monotonically_increasing_id().alias("n"), F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    hashed = text.select("n", "id", shingles("w").alias("sh"))
    marked = hashed.select("n", "id", "sh", F.filter(F.transform("sh", lambda x, i: F.when(of_template(x), i)), lambda i: i.isNotNull()).alias("hits"))
    starts = marked.select("n", "id", "sh", F.when(F.size("sh") == 1, F.array(F.lit(0))).otherwise(_windows()).alias("starts"))
    retrieved = starts.select("n", "id", "sh", F.filter(F.transform("starts", lambda s: F.struct(
        s.alias("at"), F.filter(band_keys(F.slice("sh", s + 1, WINDOW - 1)), of_piece).alias("hit"))),
        lambda x: F.size(x["hit"]) > 0).alias("found"))
    rows = retrieved.select("n", "id", F.explode(F.transform("found", lambda x: F.struct(
        x["at"].alias("at"), F.array_distinct(x["hit"]).alias("hit"),
        # of the words around a window, only template shingles matter
        F.filter(F.slice("sh", F.greatest(x["at"] + 1 - reach, F.lit(1)), 2 * reach + WINDOW), of_template).alias("around")))).alias("x"))
    found = rows.select("n", "id", "x.at", "x.around", F.explode("x.hit").alias("key")).join(keys, "key")
    share = F.size(F.array_intersect("wanted", "around")) / F.size("wanted")
    sure = found.join(known.select("template", "licence", "wanted"), "template").withColumn("share", share)
    return (sure.where(F.col("share") >= threshold).groupBy("n", "id", "licence")
            .agg(F.max("share").alias("containment"), F.min("at").cast("bigint").alias("first_word"), F.countDistinct("at").alias("n_windows"))
            .select(F.col("id").alias(id_col), "licence", "containment", "first_word", "n_windows"))
