"""License scanning with MinHash bands and exact containment, with DataFrame functions only.

Templates (license notices) are cut in chunks of at most 64 words; a chunk belongs to the
smallest size class (8, 16, 32, 64 words) that holds it. Texts are cut in overlapping
windows of each class: windows are a quarter longer than the class and begin every
quarter, so any run of a class's length lies whole in some window. Chunks and windows are
sets of 5-word shingles. A window that contains ``CONTAINED`` of a chunk's shingles
has at least a known Jaccard similarity with it; the number of MinHash bands (of one row)
is chosen so that such a pair meets in some band but for a chance of ``MISS``. Equal bands
retrieve candidates; exact containment of the chunk's shingles in the window decides, and
a template matches if chunks with ``CONTAINED`` of its shingles do.

Windows without any shingle of any template can meet none, so they are not made: texts are
first tested for a shared shingle, exactly, in the task that reads them. Nothing is shuffled
but matches. The templates are an argument; their shingles are part of the plan and their
bands are broadcast, at most ``MAX_SHINGLES`` shingles (or one template) at a time: a larger set is
scanned in groups, each with its own pass over the texts, with the same result.

Texts are whole; words are lower-cased runs of letters and digits. Null and empty texts match
nothing. Null ids are ids like any other; rows that repeat id and text count once. Templates
of fewer than 5 words are refused. Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import words

SHINGLE = 5
CONTAINED = 0.8
CLASSES = (8, 16, 32, 64)
MISS = 1e-6
MAX_SHINGLES = 20_000

# Wording of public license notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
                 "either version 3 of the License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all copies "
            "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
            "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
            "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
            "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
            "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
            "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
            "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
            "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
            "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
             "this software for any purpose, including commercial applications, and to alter it and redistribute it "
             "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
             "you must not claim that you wrote the original software. If you use this software in a product, an "
             "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
             "versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
             "This notice may not be removed or altered from any source distribution."),
)


def bands(size: int, contained: float = CONTAINED, miss: float = MISS) -> int:
    """Bands of one row that make a window and a chunk of this class meet, but for ``miss``."""
    window = size + size // 4 - SHINGLE + 1
    # the fewest shingles a chunk of this class can have: one word more than the class below holds
    least = 1 if size == CLASSES[0] else size // 2 + 1 - SHINGLE + 1
    shared = max(1.0, math.ceil(contained * least - 1e-9))
    jaccard = shared / (window + least - shared)
    return math.ceil(math.log(miss) / math.log1p(-jaccard))


def _shingles(w: Column) -> Column:
    """Hashes of the shingles, in order, from the hashes of the words."""
    last = F.size(w) - SHINGLE
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.expr("cast(array() AS array<int>)"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))


def _minima(shingles: str, n: int) -> Column:
    """array<struct<band, least>>."""
    def least(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(band))))

    return F.array(*[F.struct(F.lit(k).alias("band"), least(k).alias("least")) for k in range(n)])


def _chunks(spark: SparkSession, templates) -> DataFrame:
    """(license, template, chunk, class, shingles, of): ``of`` is the template's number of shingles."""
    rows = spark.createDataFrame([(i, a, t) for i, (a, t) in enumerate(templates)], "template int, license string, text string")
    hashed = rows.select("license", "template", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("w"))
    # chunks overlap by the words that a shingle needs, so each shingle is in one chunk
    step = CLASSES[-1] - SHINGLE + 1
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - SHINGLE, F.lit(0)), F.lit(step))
    cut = hashed.select("license", "template", F.size("w").alias("words"), F.explode(F.transform(
        starts, lambda s: F.struct(s.alias("chunk"), F.slice("w", s + 1, F.lit(CLASSES[-1])).alias("w")))).alias("c"))
    size = F.coalesce(*[F.when(F.size("c.w") <= c, c) for c in CLASSES])
    return cut.select("license", "template", "words", F.col("c.chunk").alias("chunk"), size.alias("class"),
                      F.array_distinct(_shingles(F.col("c.w"))).alias("shingles"))


def scan(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
         contained: float = CONTAINED, miss: float = MISS) -> DataFrame:
    """One row per id and license found: id_col, license, containment (of the best template), start (word
    at which its first matching window begins, counted from 0)."""
    spark = docs.sparkSession
    chunks = [r.asDict() for r in _chunks(spark, templates).collect()]  # from the argument, not from data
    if any(c["words"] < SHINGLE for c in chunks):
        raise ValueError(f"a template has fewer than {SHINGLE} words")
    groups: list[list[dict]] = []
    held = 0
    for t in sorted({c["template"] for c in chunks}):
        own = [c for c in chunks if c["template"] == t]
        n = sum(len(c["shingles"]) for c in own)
        if not groups or held + n > MAX_SHINGLES:
            groups.append([])
            held = 0
        groups[-1] += own
        held += n
    hashed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tie"),
                         _shingles_of(F.col(text_col)).alias("all"))
    if not groups:
        return docs.select(id_col, F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).alias("start")).limit(0)
    found = reduce(lambda a, b: a.unionByName(b), [_matches(hashed, group, contained, miss) for group in groups])
    top = F.max(F.struct("containment", (-F.col("start")).alias("back"))).alias("top")
    return found.groupBy("id", "license").agg(top).select(
        F.col("id").alias(id_col), "license", F.col("top.containment").alias("containment"), (-F.col("top.back")).alias("start"))


def _matches(hashed: DataFrame, chunks: list[dict], contained: float, miss: float) -> DataFrame:
    """(id, license, containment, start) of the templates that ``chunks`` make up, in (id, tie, all: shingles of a text)."""
    spark = hashed.sparkSession
    known = sorted({x for c in chunks for x in c["shingles"]})
    total: dict[int, int] = {}
    for c in chunks:
        total[c["template"]] = total.get(c["template"], 0) + len(c["shingles"])
    sides = spark.createDataFrame(
        [(c["license"], c["template"], total[c["template"]], c["chunk"], c["class"], c["shingles"]) for c in chunks],
        "license string, template int, of int, chunk int, class int, wanted array<bigint>")
    n_bands = {c: bands(c, contained, miss) for c in CLASSES if any(x["class"] == c for x in chunks)}

    known_ = F.array(*[F.lit(x) for x in known])
    near = hashed.filter(F.arrays_overlap("all", known_))  # rows that repeat are met by the maxima below

    def windows(size: int) -> Column:
        step, n = size // 4, size + size // 4 - SHINGLE + 1
        starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(step))
        cut = F.transform(starts, lambda s: F.struct(F.lit(size).alias("class"), s.alias("start"),
                                                     F.slice("all", s + 1, F.lit(n)).alias("shingles")))
        return F.filter(cut, lambda w: F.arrays_overlap(w["shingles"], known_))

    cut = near.select("id", "tie", F.explode(F.concat(*[windows(c) for c in n_bands])).alias("w")).select("id", "tie", "w.*")
    cut = cut.withColumn("shingles", F.array_distinct("shingles"))

    def signature(rows: DataFrame, shingles: str, carried: list[str]) -> DataFrame:
        by_class = F.coalesce(*[F.when(F.col("class") == c, _minima(shingles, n)) for c, n in n_bands.items()])
        return rows.select(*carried, "class", F.explode(by_class).alias("b")).select(*carried, "class", "b.*")

    index = F.broadcast(signature(sides, "wanted", ["license", "template", "of", "chunk", "wanted"]))
    met = signature(cut, "shingles", ["id", "tie", "start", "shingles"]).join(index, ["class", "band", "least"])
    shared = F.size(F.array_intersect("shingles", "wanted"))
    held = met.select("id", "tie", "license", "template", "of", "chunk", "start", shared.alias("shared"), F.size("wanted").alias("size"))
    held = held.filter(F.col("shared") >= F.ceil(F.col("size") * contained - 1e-9))
    best = held.groupBy("id", "tie", "license", "template", "of", "chunk").agg(
        F.max("shared").alias("shared"), F.min("start").alias("start"))
    found = best.groupBy("id", "tie", "license", "template", "of").agg(F.sum("shared").alias("shared"), F.min("start").alias("start"))
    return found.filter(F.col("shared") >= F.ceil(F.col("of") * contained - 1e-9)).select(
        "id", "license", F.round(F.col("shared") / F.col("of"), 6).alias("containment"), "start")


def _shingles_of(text: Column) -> Column:
    """Shingle hashes of a text: the words are hashed once, then their hashes five by five."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.element_at(F.transform(F.array(hashed), _shingles), 1)  # binds the hashed words to a name
