"""License scans: which notices a text holds, found by MinHash bands over overlapping windows and checked exactly.

Notices are grouped by length, and a text is cut into overlapping windows of twice that length, half a window apart, so
that a notice lies whole in one of them. A window that holds a notice to the required share has at least a known
resemblance to it; the number of bands is set so that such a pair agrees on a band but for the wanted chance of a miss.
What a band retrieves counts only if the exact share of the notice's shingles in the window reaches the threshold.

A text that shares no shingle with any notice cannot agree on a band, as a band is a smallest shingle of both sides;
such texts, nearly all, are passed over after one lookup of their shingles. All of it is built-in functions, and what
is sent along is the notices alone, which are given, not gathered.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch

SHINGLE = 3
SHARE = 0.8
MISS = 1e-4


@dataclass(frozen=True)
class Notice:
    license: str
    text: str


_GNU = (
    "is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, "
    "either version {} of the License, or (at your option) any later version."
)
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)


def _gnu() -> tuple[Notice, ...]:
    """Headers and short notices of the GNU licenses, of a version alone or of later ones too."""
    names = {"GPL": ("General Public License", "23"), "LGPL": ("Lesser General Public License", ("2.1", "3")), "AGPL": ("Affero General Public License", "3")}
    made = []
    for short, (name, versions) in names.items():
        for v in versions:
            label = f"{short}-{v if '.' in v else v + '.0'}"
            made += [Notice(label, f"This {kind} {_GNU.format(name, v)}") for kind in ("program", "library")]
            made += [Notice(label, f"Licensed under the GNU {name}, version {v}."), Notice(label, f"Licensed under the GNU {name} v{v}.")]
            made += [Notice(label, f"under the terms of the GNU {name} version {v} as published by the Free Software Foundation.")]
    return tuple(made)


def _creative_commons() -> tuple[Notice, ...]:
    kinds = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives"}
    kinds |= {"BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
    made = []
    for short, name in kinds.items():
        for v in ("4.0", "3.0"):
            label = f"CC-{short}-{v}"
            scope = "International" if v == "4.0" else "Unported"
            made += [Notice(label, f"This work is licensed under a Creative Commons {name} {v} {scope} License.")]
            if label not in ("CC-BY-4.0", "CC-BY-NC-4.0"):  # listed below
                made += [Notice(label, f"Licensed under CC {short} {v}.")]
    return tuple(made)


# Notices by which public licenses are declared, and short licenses whole.
NOTICES = (
    Notice("MIT", "Released under the MIT License."),
    Notice("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    Notice("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Notice("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Notice("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    Notice("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    Notice("CC-BY-4.0", "Licensed under CC BY 4.0."),
    Notice("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    Notice("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Notice("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose"),
    *_gnu(),
    *_creative_commons(),
    Notice("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    Notice("CC0-1.0", "Licensed under the CC0 1.0 Universal Public Domain Dedication."),
    Notice("Unlicense", "This is free and unencumbered software released into the public domain."),
    Notice(
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    Notice(
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at",
    ),
    Notice(
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY,
    ),
    Notice(
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ),
    Notice("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    Notice("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
)


# What parts words: all but a single sign between letters or digits ("2.0", "and/or"), and quotes, brackets and stops even there.
_IN = r"\p{L}\p{N}\p{M}"
PARTS = rf"[^{_IN}]{{2,}}+|(?<![{_IN}])[^{_IN}]|[^{_IN}](?![{_IN}])|[\s\"()<>|:;,!?\[\]{{}}*\u201c\u201d\u00ab\u00bb]"


def terms(text: Column) -> Column:
    """Words of letters, digits and single signs inside them, in lower case; tags without attributes are left out."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"</?[a-z][a-z0-9]*\s*/?>", " ")
    return F.filter(F.split(bare, PARTS), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Hashes of the runs of words, in order; fewer words than a run are one run."""

    def runs(own: Column) -> Column:
        n = F.greatest(F.size(own) - SHINGLE + 1, F.lit(1))
        hashed = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(own, i, SHINGLE)))
        return F.when(F.size(own) > 0, hashed).otherwise(F.array().cast("array<long>"))

    return F.element_at(F.transform(F.array(words), runs), 1)  # the words are bound, so they are made once


def bands(share: float, window: int, notice: int, miss: float) -> int:
    """How many single-hash bands let a pair of the least resemblance slip with at most this chance.

    A window of ``window`` shingles that holds ``share`` of a notice of ``notice`` resembles it by at least this much.
    """
    least = share * notice / (window + (1 - share) * notice)
    return math.ceil(math.log(miss) / math.log(1 - least))


def band_keys(hashes: Column, n: int) -> Column:
    """The smallest value of the shingles under each of the hash functions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda seed: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, seed)))
    )


def length_class(n: Column) -> Column:
    """Notices of 2**k to 2**(k+1) - 1 shingles are looked for together."""
    return F.floor(F.log2(n.cast("double"))).cast("int")


def scan(
    docs: DataFrame,
    notices: tuple[Notice, ...] = NOTICES,
    doc_id: str = "doc_id",
    text: str = "text",
    share: float = SHARE,
    miss: float = MISS,
) -> DataFrame:
    """Each place of a notice in a text: license, notice, first word of the place, share of the notice's shingles.

    Null text holds none; documents without an id and repeated rows are listed as often as they stand; an empty table
    gives no rows; other columns are neither read nor returned. Where places of one family of licenses overlap, the
    fullest counts; places apart are all listed.
    """
    spark = docs.sparkSession
    given = spark.createDataFrame([(i, n.license, n.text) for i, n in enumerate(notices)], "notice int, license string, text string")
    own = given.select("notice", "license", F.array_distinct(shingles(terms(F.col("text")))).alias("wanted"))
    sized = own.withColumn("class", length_class(F.size("wanted")))
    known = [list(r) for r in sized.select("class", "wanted").collect()]  # the notices' own shingles
    used = sorted({c for c, _ in known})
    every = F.array(*[F.lit(h) for h in sorted({h for _, w in known for h in w})])
    width = {c: 4 << c for c in used}  # twice the longest notice of the class
    count = {c: max(bands(share, width[c], len(w), miss) for k, w in known if k == c) for c in used}

    hashed = docs.select(F.col(doc_id).alias("doc_id"), shingles(terms(F.col(text))).alias("hashes"))
    held = hashed.where(F.arrays_overlap("hashes", every)).withColumn("row", F.monotonically_increasing_id())
    held = scratch.written(held, "held")  # fixes the row numbers
    looks = None
    for c in used:
        step = width[c] // 2
        windows = held.select(
            "row",
            "doc_id",
            F.lit(c).alias("class"),
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), F.greatest(F.floor((F.size("hashes") - 1) / step), F.lit(0)).cast("int")),
                    lambda i: F.struct((i * step).alias("at"), F.slice("hashes", i * step + 1, width[c]).alias("window")),
                )
            ).alias("w"),
        ).where(F.arrays_overlap("w.window", every))
        keyed = windows.select("row", "doc_id", "class", "w.at", "w.window", F.posexplode(band_keys(F.col("w.window"), count[c])).alias("band", "key"))
        looks = keyed if looks is None else looks.unionByName(keyed)
    listed = None
    for c in used:
        part = sized.where(F.col("class") == c).select("notice", "license", "class", "wanted", F.posexplode(band_keys(F.col("wanted"), count[c])).alias("band", "key"))
        listed = part if listed is None else listed.unionByName(part)
    met = looks.join(F.broadcast(listed), ["class", "band", "key"])  # bounded: bands times the given notices
    found = met.withColumn("share", F.size(F.array_intersect("window", "wanted")) / F.size("wanted")).where(F.col("share") >= share)
    pairs = found.select("row", "notice").distinct()
    return _apart(_places(pairs, held, sized, share)).select("doc_id", "license", "notice", "at", "share")


def _places(pairs: DataFrame, held: DataFrame, notices: DataFrame, share: float) -> DataFrame:
    """Every place of a found notice in its text: from the first to the last of its shingles there.

    From each shingle of the notice on, twice the notice's length is looked at; of places that overlap the fullest
    stays, the shortest among equals.
    """
    given = F.broadcast(notices.select("notice", "license", "wanted"))  # given, not gathered
    hits = pairs.join(held, "row").join(given, "notice").select("row", "doc_id", "notice", "license", "wanted", F.posexplode("hashes").alias("pos", "h"))
    hits = hits.where(F.array_contains("wanted", F.col("h"))).withColumn("size", F.size("wanted")).drop("wanted")
    listed = hits.groupBy("row", "doc_id", "notice", "license", "size").agg(F.array_sort(F.collect_list(F.struct("pos", "h"))).alias("hits"))

    def span(x: Column, i: Column) -> Column:
        # at most 2 * size shingles of the notice can stand in the span
        ahead = F.filter(F.slice("hits", i + 1, 2 * F.col("size")), lambda y: y["pos"] < x["pos"] + 2 * F.col("size"))
        kinds = F.array_distinct(F.transform(ahead, lambda y: y["h"]))
        first = F.transform(kinds, lambda h: F.array_min(F.transform(F.filter(ahead, lambda y: y["h"] == h), lambda y: y["pos"])))
        return F.struct(x["pos"].alias("at"), F.array_max(first).alias("last"), (F.size(kinds) / F.col("size")).alias("share"))

    spans = F.filter(F.transform("hits", span), lambda x: x["share"] >= share)
    spans = listed.select("row", "doc_id", "notice", "license", spans.alias("spans"))

    def fuller(x: Column, y: Column) -> Column:
        longer = (x["share"] == y["share"]) & (x["last"] - x["at"] < y["last"] - y["at"])
        return (x["share"] > y["share"]) | longer

    def kept(so_far: Column, x: Column) -> Column:
        before = F.element_at(so_far, -1)
        held_back = F.slice(so_far, 1, F.size(so_far) - 1)
        return (
            F.when(F.size(so_far) == 0, F.array(x))
            .when(x["at"] > before["last"], F.concat(so_far, F.array(x)))
            .when(fuller(x, before), F.concat(held_back, F.array(x)))
            .otherwise(so_far)
        )

    empty = F.array().cast("array<struct<at:int,last:int,share:double>>")
    return spans.select("row", "doc_id", "notice", "license", F.explode(F.aggregate("spans", empty, kept)).alias("place")).select(
        "row", "doc_id", "notice", "license", "place.*"
    )


def _apart(places: DataFrame) -> DataFrame:
    """Notices that differ in a number or a word are found at one place together; of a family the fullest counts there.

    Of equally full ones the longest counts. The GNU licenses are one family.
    """
    family = Window.partitionBy("row", F.regexp_replace(F.substring_index("license", "-", 1), "^[AL]GPL$", "GPL"))
    seen = places.withColumn("all", F.collect_list(F.struct("at", "last", "share")).over(family))
    longer = lambda y: (y["share"] == F.col("share")) & (y["last"] - y["at"] > F.col("last") - F.col("at"))
    beaten = F.exists("all", lambda y: ((y["share"] > F.col("share")) | longer(y)) & (y["at"] <= F.col("last")) & (F.col("at") <= y["last"]))
    return seen.where(~beaten)
