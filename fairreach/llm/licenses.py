"""License notices in texts, by DataFrame functions alone.

Templates are word sequences; a shingle is five words (a shorter template is one shingle of its own length). For each
template size, overlapping windows of that many shingles are laid over a text, a fifth of their length apart. A window
whose MinHash agrees with a template's in one of the bands (one row each) retrieves the template, and the window
with some context is then compared shingle by shingle, as text: a match holds at least 0.8 of the template's shingles.

A window can only agree in a band if its smallest shingle hash is one of the template's, so windows without any template
shingle are never looked at; this leaves nothing out. Bands: a notice with a fifth of its shingles changed, in
the window that fits it worst, has a Jaccard similarity of 0.72 / 1.28 = 0.56 or more; 12 bands of one row find it with
a probability of 1 - 0.44^12 > 0.9999. Exact notices agree in 0.9 / 1.1: 1 - 0.18^12.

All of it is one projection of each row: no shuffle, no Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairreach.llm.common import let, table
from fairreach.llm.registry import query

SHINGLE, BANDS, LEAST = 5, 12, 0.8
#: Name and notice (fixed values: wording of the licenses).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions",
    ),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at",
    ),
    (
        "GPL-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-opening",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    ),
    (
        "BSD-2-Clause",
        "in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. This software is provided by the copyright holders and "
        "contributors as is and any express or implied warranties",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    (
        "LGPL",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
    ),
    (
        "AGPL",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> list[str]:
    return re.findall(_WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def word_array(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _upto(n: Column) -> Column:
    """0 .. n-1, or nothing."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _shingle_hashes(hashes: Column, size: int) -> Column:
    """Hash of each run of ``size`` word hashes."""
    return F.transform(_upto(F.size(hashes) - (size - 1)), lambda i: F.xxhash64(F.slice(hashes, i + 1, size)))


def _band(hashes: Column, band: int) -> Column:
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))


def _prepared(spark: SparkSession, templates) -> list[dict]:
    """Words, shingle hashes and MinHashes of each template, hashed by the functions that hash the texts."""
    rows = [(k, name, _words(text)) for k, (name, text) in enumerate(templates)]
    rows = [(k, name, words, min(SHINGLE, len(words))) for k, name, words in rows if words]
    out = []
    for size in sorted({r[3] for r in rows}):
        own = spark.createDataFrame([r[:3] for r in rows if r[3] == size], "k int, name string, words array<string>")
        own = own.withColumn("hashes", _shingle_hashes(F.transform("words", lambda w: F.xxhash64(w)), size))
        own = own.withColumn("bands", F.array([_band(F.col("hashes"), b) for b in range(BANDS)]))
        out += [r.asDict() | {"size": size} for r in own.orderBy("k").collect()]
    return out


def _shingled(size: int, body: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Of words, ``body`` of their shingle hashes."""
    return lambda words: let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(_shingle_hashes(h, size), lambda s: body(s)))


def _all_matches(words: Column, groups: list[list[dict]], size: int, least: float) -> Callable[[Column], Column]:
    return lambda shingles: F.concat(*[_matches(words, shingles, g, size, least) for g in groups])


def find_licenses(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``doc_id, license, containment, word_begin, word_end`` for each row and notice that it holds.

    containment is the share of the template's distinct shingles in a window with its context (a fifth of the
    template on either side), word_begin .. word_end that stretch. Of verified windows of one template that overlap, the one with the
    largest share is reported, the first of equals; windows apart are notices of their own. Null, empty and other
    texts without a template give no row; repeated rows give theirs again; templates without words match nothing.
    """
    prepared = _prepared(docs.sparkSession, templates)
    sizes = sorted({t["size"] for t in prepared})
    docs = docs.select("doc_id", "text")
    kind = "array<struct<license:string,containment:double,word_begin:int,word_end:int>>"
    matches = F.expr(f"cast(array() as {kind})")
    if prepared:
        hit = F.lit(False)
        for size in sizes:
            known = F.lit(sorted({h for t in prepared if t["size"] == size for h in t["hashes"]}))
            hit |= let(word_array(F.col("text")), _shingled(size, partial(F.arrays_overlap, known)))
        docs = docs.where(F.col("text").isNotNull() & hit)

        def look(words: Column) -> Column:
            found = []
            for size in sizes:
                own = [t for t in prepared if t["size"] == size]
                lengths = sorted({len(t["hashes"]) for t in own})
                by_length = [[t for t in own if len(t["hashes"]) == n] for n in lengths]
                found.append(_shingled(size, _all_matches(words, by_length, size, least))(words))
            return F.concat(*found)

        matches = let(word_array(F.col("text")), look)
    rows = docs.select("doc_id", F.explode(matches).alias("m"))
    return rows.select("doc_id", "m.license", "m.containment", "m.word_begin", "m.word_end")


def _matches(words: Column, shingles: Column, group: list[dict], size: int, least: float) -> Column:
    """All matches of each template of ``group`` (all with as many shingles) in a row, as an array of structs."""
    length = len(group[0]["hashes"])
    stride, margin = max(1, length // 5), -(-length // 5)
    hashes = F.lit(sorted({h for t in group for h in t["hashes"]}))
    hits = F.filter(_upto(F.size(shingles)), lambda i: F.array_contains(hashes, F.get(shingles, i)))

    def around(i: Column) -> Column:
        """Windows that hold shingle i: they begin at multiples of the stride."""
        first = F.greatest(F.lit(0), F.ceil((i - (length - 1)) / stride).cast("int"))
        return F.transform(F.sequence(first, F.floor(i / stride).cast("int")), lambda w: w * stride)

    begins = F.array_sort(F.array_distinct(F.flatten(F.transform(hits, around))))

    def retrieve(begin: Column) -> Column:
        window = F.slice(shingles, begin + 1, length)
        low = F.greatest(F.lit(0), begin - margin)
        last = F.least(low + length + 2 * margin, F.size(shingles))
        wide = F.transform(F.sequence(low, last - 1), lambda i: F.array_join(F.slice(words, i + 1, size), " "))
        bands = F.array(*[_band(window, b) for b in range(BANDS)])

        def verified(t: dict) -> Column:
            texts = sorted({" ".join(t["words"][i : i + size]) for i in range(length)})
            share = F.size(F.array_intersect(F.lit(texts), wide)) / F.lit(float(len(texts)))
            end = (last + size - 1).alias("word_end")
            match = F.struct(F.lit(t["name"]).alias("license"), share.alias("containment"), low.alias("word_begin"), end, begin.alias("at"))
            return let(match, lambda m: F.when(m["containment"] >= least, m))

        def agreeing(mine: Column) -> Column:
            agree = lambda t: F.exists(F.arrays_zip(mine.alias("a"), F.lit(t["bands"]).alias("b")), lambda z: z["a"] == z["b"])
            return F.filter(F.array(*[F.when(agree(t), verified(t)) for t in group]), lambda x: x.isNotNull())

        return let(bands, agreeing)

    none = F.expr("cast(array() as array<struct<lack:double,at:int,begin:int,end:int>>)")

    def apart(seen: Column, t: dict) -> Column:
        """The matches of one template, the best first, without those that overlap a better one."""
        own = F.filter(seen, lambda x: x["license"] == t["name"])
        ranked = F.transform(own, lambda x: F.struct((-x["containment"]).alias("lack"), x["at"].alias("at"), x["word_begin"].alias("begin"), x["word_end"].alias("end")))
        kept = F.aggregate(F.array_sort(ranked), none, lambda acc, x: F.when(F.exists(acc, lambda a: F.abs(a["at"] - x["at"]) < length), acc).otherwise(F.concat(acc, F.array(x))))
        return F.transform(kept, lambda x: F.struct(F.lit(t["name"]).alias("license"), (-x["lack"]).alias("containment"), x["begin"].alias("word_begin"), x["end"].alias("word_end")))

    seen = F.flatten(F.transform(begins, retrieve))
    return let(seen, lambda x: F.concat(*[apart(x, t) for t in group]))


@query("op7_license_scans")
def op7(spark, sf_dir):
    return find_licenses(table(spark, sf_dir, "documents"))
