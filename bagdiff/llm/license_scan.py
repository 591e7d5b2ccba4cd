"""License notices by an exact set-similarity join, in DataFrame operations alone.

Words are runs of a-z, 0-9 and everything beyond ASCII, A-Z lower-cased. A template of n
words, one line or a license's whole text, is looked for in text blocks of n + n/6
consecutive words (rounded down), starting every n/6 + 1 words, so any n consecutive words
lie whole in one, and words that only stand far apart in none. A block matches a template when it has at least ``threshold`` of the
template's distinct words.

Where a template's words lie all inside those of a template with another label, both
have the blocks of the longer. In a block that matches templates of several labels, one
yields to another that shares all of its shared words with the block, and more, or a
larger part of its own: "CC BY-SA 4.0" is not also "CC BY 4.0".

The join: the templates' words are ordered by the number of documents that have
them, rarest first, counted over all documents. A match of at least c of a
template's s words has one of its s - c + 1 rarest (prefix filter), so blocks join
templates on those words only. A block with under c template words is skipped
(length filter), as is a pair whose first shared word stands too late in either
order for c to be reached (positional filter). Only blocks around a prefix word are
made at all. What is left is verified on the full sets. Each pair is taken up at its first shared prefix word, so once.

Words of documents never leave their task; the driver holds the templates, a
parameter, and one count for each of their words.

Base phrases (consecutive words) are found beside it, for every place.

Defined results: a null or empty text has no words, places or labels and score 0.
Repeated rows are judged each for itself; other columns are ignored. Among equal
counts words are ordered by spelling, which cannot change results.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import ascii_lower, materialize

THRESHOLD = 0.9

#: Base phrases and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

#: The wording of public licenses' notices, and labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the"
        " GNU General Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("agpl", "Licensed under the GNU Affero General Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
    ),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        ' and associated documentation files (the "Software"), to deal in the Software without restriction,'
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the Software."
        ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT'
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
        " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
        " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE"
        " SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
        ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE'
        " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE"
        " FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS"
        " OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING"
        " OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


#: What stands between words.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    # cutting between words costs a tenth of extracting them; a text may begin or end between words
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def template_words(text: str) -> list[str]:
    """Distinct words of a template, in order."""
    return list(dict.fromkeys(re.findall(WORD, text.lower())))


def least_shared(size: int, threshold: float) -> int:
    """The smallest number of shared words that reaches the threshold."""
    return max(1, math.ceil(size * threshold - 1e-9))


def block_words(templates) -> list[int]:
    """For each template the number of words that its blocks are made for.

    This is its own number of words, or that of the longest template it is linked to by
    containment of one's words in the other's, of another label.
    """
    words = [(label, set(template_words(t))) for label, t in templates]
    longest = [len(re.findall(WORD, t.lower())) for _, t in templates]
    links = [(t, u) for t, (k, a) in enumerate(words) for u, (m, b) in enumerate(words) if k != m and a < b]
    for _ in templates:  # a chain of containments has no more steps
        for t, u in links:
            longest[t] = longest[u] = max(longest[t], longest[u])
    return longest


def block_of(n: int) -> tuple[int, int]:
    """Words in a block for templates of n words, and from one block's start to the next: n consecutive words fit whole."""
    return n + n // 6, n // 6 + 1


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _places(words: Column, phrases) -> Column:
    """struct(start, label) of every place of a phrase; looked for only where a phrase's last word occurs."""
    lasts = sorted({p.split(" ")[-1] for p, _ in phrases})

    def at(word, i):
        found = F.lit(None).cast("struct<start:bigint,label:string>")
        for phrase, label in phrases:
            parts = phrase.split(" ")
            n = len(parts)
            fits = word == parts[-1]
            for back in range(1, n):
                fits = fits & (F.get(words, i - back) == parts[-1 - back])
            place = F.struct((i - (n - 1)).cast("bigint").alias("start"), F.lit(label).alias("label"))
            found = F.when(fits, place).otherwise(found)
        return found

    searched = F.filter(F.transform(words, at), lambda x: x.isNotNull())
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    return F.when(F.arrays_overlap(words, _strings(lasts)), searched).otherwise(none)


def _prefix(own: list[str], threshold: float) -> list[str]:
    """The words of a template, in global order, of which any match has at least one."""
    return own[: len(own) - least_shared(len(own), threshold) + 1]


def _prefixes(spark, templates, owns, threshold: float) -> DataFrame:
    """One row per prefix word of each template: n, word, label, place in its order, words before it, its words, least."""
    rows = []
    for (label, _), own, n in zip(templates, owns, block_words(templates), strict=True):
        for i, word in enumerate(_prefix(own, threshold)):
            rows.append(
                F.struct(
                    F.lit(n).alias("n"),
                    F.lit(word).alias("word"),
                    F.lit(label).alias("label"),
                    F.lit(i).alias("i"),
                    _strings(own[:i]).alias("earlier"),
                    _strings(own).alias("own"),
                    F.lit(least_shared(len(own), threshold)).alias("least"),
                )
            )
    return spark.range(1).select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def _blocks(n: int, prefix, vocabulary, least: int) -> Column:
    """struct(n, block) of each block for templates of n words that has one of ``prefix``: its words of ``vocabulary``, in order.

    Reads the columns ``words`` and ``marks`` (struct(i, word) of the words that any template's prefix has).
    """
    length, step = block_of(n)

    def starts(m):
        first = F.greatest(F.floor((m["i"] - length + step) / step), F.lit(0)) * step
        return F.sequence(first.cast("int"), (F.floor(m["i"] / step) * step).cast("int"), F.lit(step))

    at = F.flatten(F.transform(F.filter("marks", lambda m: m["word"].isin(prefix)), starts))

    def block(s):
        held = F.array_intersect(_strings(vocabulary), F.slice(F.col("words"), s + 1, length))
        return F.struct(F.lit(n).alias("n"), held.alias("block"))

    return F.filter(F.transform(F.array_distinct(at), block), lambda b: F.size(b["block"]) >= least)


def scan(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    templates=TEMPLATES,
    phrases=PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``df``: ``id``, n_words, places (array of start and label), matches (array of label and share)."""
    vocabulary = sorted({w for _, t in templates for w in template_words(t)})
    docs = df.select(F.col(id).alias("id"), words_of(F.col(text)).alias("words"))
    seen = docs.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("word"))
    counts = {r.word: r.n for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranked = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    order = {w: i for i, w in enumerate(ranked)}
    owns = [sorted(template_words(t), key=order.__getitem__) for _, t in templates]
    prefixes = _prefixes(df.sparkSession, templates, owns, threshold)
    sizes: dict[int, list[list[str]]] = {}
    for own, n in zip(owns, block_words(templates), strict=True):
        sizes.setdefault(n, []).append(own)
    rare = sorted({w for own in owns for w in _prefix(own, threshold)})
    none = F.array().cast("array<struct<i:int,word:string>>")
    marks = F.transform("words", lambda w, i: F.when(w.isin(rare), F.struct(i.alias("i"), w.alias("word"))))
    marks = F.when(F.arrays_overlap("words", _strings(rare)), F.filter(marks, lambda m: m.isNotNull())).otherwise(none)
    docs = docs.select("*", marks.alias("marks"))
    # blocks as their template words in global order, around prefix words alone
    cut = [
        _blocks(
            n,
            sorted({w for own in of for w in _prefix(own, threshold)}),
            sorted({w for own in of for w in own}, key=order.__getitem__),
            min(least_shared(len(own), threshold) for own in of),
        )
        for n, of in sorted(sizes.items())
    ]
    blocks = F.when(F.size("marks") > 0, F.array_distinct(F.concat(*cut)))
    rows = docs.select(
        "id",
        F.size("words").cast("bigint").alias("n_words"),
        _places(F.col("words"), phrases).alias("places"),
        blocks.alias("blocks"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "license-rows")  # row numbers are fixed by writing them
    held = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.n", "b.block")
    listed = held.select("row", "n", "block", F.posexplode("block").alias("j", "word"))
    size = F.size("block")
    reachable = 1 + F.least(F.size("own") - F.col("i") - 1, size - F.col("j") - 1)
    pairs = (
        listed.join(F.broadcast(prefixes), ["n", "word"])  # a parameter: a few rows per template
        .filter(size >= F.col("least"))
        .filter(~F.arrays_overlap("earlier", "block"))
        .filter(reachable >= F.col("least"))
        .withColumn("shared", F.array_intersect("own", "block"))
        .filter(F.size("shared") >= F.col("least"))
    )
    share = (F.size("shared") / F.size("own")).cast("double")
    # a block's pairs, at most one for each template
    pair = F.struct("label", "shared", share.alias("share"))
    matched = pairs.groupBy("row", "n", "block").agg(F.collect_list(pair).alias("pairs"))

    def stays(p):
        def takes(q):
            inside = F.size(F.array_except(p["shared"], q["shared"])) == 0
            more = (F.size(q["shared"]) > F.size(p["shared"])) | (q["share"] > p["share"])
            return (q["label"] != p["label"]) & inside & more

        return ~F.exists("pairs", takes)

    matched = matched.select("row", F.explode(F.filter("pairs", stays)).alias("p"))
    best = matched.groupBy("row", F.col("p.label").alias("label")).agg(F.max("p.share").alias("share"))
    matches = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("label", "share"))).alias("matches"))
    none = F.array().cast("array<struct<label:string,share:double>>")
    return rows.join(matches, "row", "left").select(
        F.col("id").alias(id), "n_words", "places", F.coalesce("matches", none).alias("matches")
    )
