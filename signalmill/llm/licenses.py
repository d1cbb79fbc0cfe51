"""License scans: text blocks that contain a license notice, by an exact set-similarity join in SQL functions.

Texts are lower-cased (A-Z) words of letters and digits. Two things are found:

* places where the words of a phrase that names a license stand one after another (``PHRASES``);
* blocks that contain a notice (``TEMPLATES``): a block is a window of words, a notice is the set of its words,
  and the share of the notice's words that stand in the block is THRESHOLD or more. A notice is sought in
  blocks at least twice as long as itself, which begin every half block, so it lies whole in one of them.

The join compares few pairs, yet misses none. The words of all notices are ordered by how often
they occur, rarest first, counted over all documents. Let a notice have t words, of which o must be met:

* prefix filter: one of its t - o + 1 rarest words is among the b - o + 1 rarest of the block's b words that
  notices use. Whole texts without any such word, and then blocks, are passed over first;
* length filter: b is o or more;
* positional filter: the first word in common is the i-th of the notice and the j-th of the block, so that at
  most 1 + min(t - i, b - j) words can be in common; that must be o or more;
* what is left is counted in full.

Notices and phrases are parameters of a size that the caller sets; their words' counts are all that the driver
reads, and they are part of the plan. Texts are not shuffled: each row is scanned where it is.

Defined cases: a null or empty text has 0 words and no labels; ties give all blocks and labels; rows are handled
alone, so repeated rows and null ids give what each gives; a kept column named like one of the results is
replaced by it; without rows there are no results, and notices are ordered by their words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .packed import ready

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Beyond ASCII only what has no capitals passes: lower() would change others, so such texts are translated.
MAY_BE_CAPITAL = r"[^\x00-\xBF\xD7\xDF-\xFF\u2000-\u206F\u3000-\u9FFF]"
THRESHOLD = 0.8
LEAST_BLOCK = 16

# Phrases that name a license.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Notices of public licenses, as their texts tell authors to give them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. Unless required by applicable law or agreed to in writing, software distributed under the "
     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
     "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)

PLACES = "array<struct<place: bigint, label: string>>"
BLOCKS = "array<struct<template: int, label: string, first_word: bigint, shared: int, containment: double>>"
RESULTS = ("n_words", "places", "blocks", "base_labels", "labels", "score")


@dataclass(frozen=True)
class Notice:
    """A template's distinct words, how many of them must be met, and the width of its blocks."""

    number: int
    label: str
    words: tuple[str, ...]
    least: int
    width: int


def words_in(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(CAPITALS, CAPITALS.lower())))


def notices(templates: Iterable[tuple[str, str]], threshold: float = THRESHOLD) -> list[Notice]:
    """Templates without words are no notices."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a share above 0")
    out = []
    for i, (label, text) in enumerate(templates):
        words = words_in(text)
        kinds = tuple(dict.fromkeys(words))
        if kinds:
            width = max(LEAST_BLOCK, 1 << (2 * len(words) - 1).bit_length())
            out.append(Notice(i, label, kinds, math.ceil(round(threshold * len(kinds), 9)), width))
    return out


def words_of(text: Column) -> Column:
    """The words of a text: runs of letters, digits and all beyond ASCII, A-Z lower-cased."""
    text = F.coalesce(text, F.lit(""))
    small = F.when(text.rlike(MAY_BE_CAPITAL), F.translate(text, CAPITALS, CAPITALS.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(small, GAP), "")


def word_counts(words: DataFrame, kinds: list[str]) -> dict[str, int]:
    """How often each of ``kinds`` occurs in all rows: one map-side combined count."""
    if not kinds:
        return {}
    every = words.select(F.explode("words").alias("word")).filter(F.col("word").isin(kinds))
    return {r["word"]: r["count"] for r in every.groupBy("word").count().collect()}


def _list(words: list[str]) -> Column:
    """A constant array; words hold no spaces."""
    return F.split(F.lit(" ".join(words)), " ") if words else F.array().cast("array<string>")


def _places_of(words: Column, phrase: str, label: str) -> Column:
    """Where the words of a phrase stand one after another, in order."""
    parts = words_in(phrase)

    def stands(i: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.get(words, i + k) == w for k, w in enumerate(parts)])

    at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), stands)
    places = F.transform(at, lambda i: F.struct(i.cast("bigint").alias("place"), F.lit(label).alias("label")))
    return F.when(F.array_contains(words, parts[0]), places).otherwise(F.array().cast(PLACES))


def _phrase_places(words: Column, phrases: Mapping[str, str]) -> Column:
    """Where phrases stand: (place, label), one phrase after another; phrases without words stand nowhere."""
    return F.concat(F.array().cast(PLACES), *(_places_of(words, p, label) for p, label in phrases.items() if words_in(p)))


def _rank(rank: Mapping[str, tuple[int, str]], word: str) -> tuple[int, str]:
    return rank.get(word, (0, word))


def _ordered(words: Iterable[str], rank: Mapping[str, tuple[int, str]]) -> list[str]:
    """Words by how often they occur, rarest first."""
    return sorted(words, key=lambda w: _rank(rank, w))


def _prefix(x: Notice, rank: Mapping[str, tuple[int, str]]) -> list[str]:
    """The rarest words of a notice, of which a block that contains it has one."""
    return _ordered(x.words, rank)[: len(x.words) - x.least + 1]


def _notice_blocks(words: Column, wanted: list[Notice], rank: Mapping[str, tuple[int, str]]) -> Column:
    """Blocks that contain notices: (template, label, first_word, shared, containment)."""
    widths = sorted({x.width for x in wanted})
    return F.concat(F.array().cast(BLOCKS), *(_blocks_of(words, w, [x for x in wanted if x.width == w], rank) for w in widths))


def _blocks_of(words: Column, width: int, group: list[Notice], rank: Mapping[str, tuple[int, str]]) -> Column:
    """The blocks of one width that contain notices; texts without any of the notices' rarest words have none."""
    kinds = _list(_ordered({w for x in group for w in x.words}, rank))
    rarest = _list(sorted({w for x in group for w in _prefix(x, rank)}))
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(width // 2))
    blocks = F.transform(starts, lambda s: F.struct(s.alias("begin"), F.array_intersect(kinds, F.slice(words, s + 1, width)).alias("held")))
    probed = F.filter(blocks, lambda b: F.arrays_overlap(b["held"], rarest))
    matched = F.flatten(F.transform(probed, lambda b: _matches(b, group, rank)))
    return F.when(F.arrays_overlap(words, rarest), matched).otherwise(F.array().cast(BLOCKS))


def _matches(block: Column, group: list[Notice], rank: Mapping[str, tuple[int, str]]) -> Column:
    """The notices of one width that a block contains."""
    held = block["held"]
    out = []
    for x in group:
        ordered, t, o = _ordered(x.words, rank), len(x.words), x.least
        common = F.array_intersect(_list(_prefix(x, rank)), F.slice(held, F.lit(1), F.greatest(F.size(held) - o + 1, F.lit(0))))
        first = F.get(common, F.lit(0))
        i, j = F.array_position(_list(ordered), first), F.array_position(held, first)
        possible = F.lit(1) + F.least(F.lit(t) - i, F.size(held) - j)
        shared = F.size(F.array_intersect(_list(ordered), held))
        passed = (F.size(held) >= o) & (F.size(common) > 0) & (possible >= o) & (shared >= o)
        counted = F.when(passed, shared).otherwise(F.lit(0))
        out.append(
            F.struct(
                F.lit(x.number).alias("template"), F.lit(x.label).alias("label"), block["begin"].cast("bigint").alias("first_word"),
                counted.alias("shared"), (counted / F.lit(float(t))).alias("containment"),
            )
        )
    return F.filter(F.array(*out), lambda m: m["shared"] > 0)


def scan(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    templates: Iterable[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The kept columns with n_words, places, blocks, base_labels, labels and score.

    ``places`` are those of phrases (place, label), ``blocks`` those that contain notices (template, label,
    first_word, shared, containment). Labels are distinct and sorted; the score is 1 where a phrase stands,
    else the greatest containment of a block, else 0.
    """
    ready(docs.sparkSession)
    wanted = notices(templates, threshold)
    kept = [F.col(f"`{k}`") for k in keep if k not in RESULTS]
    # A generator that makes one row of each keeps what it gives from being computed for each use.
    words = docs.select(F.struct(*kept).alias("row"), F.explode(F.array(words_of(F.col(f"`{text}`")))).alias("words"))
    named = [words_in(p) for p in phrases]
    counts = word_counts(words, sorted({w for x in wanted for w in x.words} | {w for p in named for w in p}))
    rank = {w: (n, w) for w, n in counts.items()}
    rarest = {w for x in wanted for w in _prefix(x, rank)} | {min(p, key=lambda w: _rank(rank, w)) for p in named if p}
    w = F.col("words")
    both = F.struct(_phrase_places(w, phrases).alias("places"), _notice_blocks(w, wanted, rank).alias("blocks"))
    none = F.struct(F.array().cast(PLACES).alias("places"), F.array().cast(BLOCKS).alias("blocks"))
    found = words.select(
        "row", F.size(w).cast("bigint").alias("n_words"),
        F.explode(F.array(F.when(F.arrays_overlap(w, _list(sorted(rarest))), both).otherwise(none))).alias("found"),
    ).select("row", "n_words", "found.places", "found.blocks")
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    every = F.array_sort(F.array_distinct(F.concat("places.label", "blocks.label")))
    best = F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))
    return found.select(
        *(F.col("row")[k].alias(k) for k in keep if k not in RESULTS),
        "n_words", "places", "blocks", base.alias("base_labels"), every.alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
