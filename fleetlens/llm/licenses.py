"""License scans in DataFrame operations alone.

Every text becomes five-word shingle hashes, and windows over them.  Windows
are MinHashed; each of ``BANDS`` one-row bands that equals a band of a template
window retrieves that template, so a pair of windows with similarity ``s``
meets with probability ``1 - (1 - s) ** BANDS`` (above 0.99998 from s = 0.5).
A band can only agree if the text window holds the template window's smallest
shingle under that band, so windows without any such shingle are skipped before
they are MinHashed; this loses nothing.  Retrieved templates are verified by
the exact containment of their shingles, as strings, in the whole text.

Documents are never shuffled: what is exploded and joined are windows around
shingles that templates have, and of the text itself only which of the
templates' shingles it holds and where each first stands.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 16
#: Share of a template's shingles that the text must hold.
MIN_CONTAINMENT = 0.8
#: Window widths in shingles, their strides, and the fewest shingles of templates that are cut into them.
WINDOWS = ((2, 1, 1), (8, 4, 8))

#: Notices and key sentences of public licenses.
TEMPLATES: dict[str, str] = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "MIT notice": "Released under the MIT License",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Apache-2.0 header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "BSD grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it and wherever the optimizer moves it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _per_shingle(w: Column, make: Callable[..., Column]) -> Column:
    """``make`` of each five words in a row; an empty array for fewer words."""

    def of(w: Column) -> Column:
        at = F.when(F.size(w) >= SHINGLE, F.sequence(F.lit(0), F.size(w) - SHINGLE)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: make(*[F.get(w, i + k) for k in range(SHINGLE)]))

    return let(w, of)


def shingle_hashes(w: Column) -> Column:
    return _per_shingle(w, F.xxhash64)


def shingle_strings(w: Column) -> Column:
    return _per_shingle(w, lambda *five: F.concat_ws(" ", *five))


def minhash(hashes: Column) -> Column:
    """BANDS minima, each under another order of the hashes."""
    masks = F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda k: F.xxhash64(F.lit("band"), k))
    return let(hashes, lambda own: F.transform(masks, lambda m: F.array_min(F.transform(own, lambda h: h.bitwiseXOR(m)))))


def cut(starts: Column, width: int) -> Column:
    return F.transform(starts, lambda s: F.slice("h", s, width))


def covering(at: Column, kind: int, width: int, stride: int) -> Column:
    """The windows of one width on its grid that cover any of the shingles ``at``."""
    back = F.sequence(F.lit(0), F.lit(width // stride - 1))
    return F.flatten(F.transform(at, lambda p: F.transform(back, lambda b: F.struct(F.lit(kind).alias("class"), ((F.floor(p / stride) - b) * stride).cast("int").alias("start")))))


def template_windows(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """template, its distinct shingles, a window's width class, band and value; size fixed by the templates."""
    rows = F.array(*[F.struct(F.lit(k).alias("template"), F.lit(v).alias("body")) for k, v in templates.items()])
    base = (
        spark.range(1)
        .select(F.inline(rows))
        .withColumn("w", words(F.col("body")))
        .select("template", F.array_distinct(shingle_strings(F.col("w"))).alias("shingles"), shingle_hashes(F.col("w")).alias("h"))
        .where("size(h) > 0")
    )
    parts = []
    for k, (width, _, fewest) in enumerate(WINDOWS):
        most = min([f for _, _, f in WINDOWS if f > fewest], default=1 << 30)
        own = base.where((F.size("h") >= fewest) & (F.size("h") < most))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("h") - width + 1))  # every offset, so a text's grid meets an equal window
        parts.append(own.select("template", "shingles", F.lit(k).alias("class"), F.explode(cut(starts, width)).alias("window")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("template", "shingles", "class", F.posexplode(minhash(F.col("window"))).alias("band", "value")).distinct()


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document and template that it holds: id, template, containment, and the word where the first of its shingles stands.

    Documents without a template, or with null text or fewer than SHINGLE
    words, have no row; templates that short are never found.  Texts of any
    length are scanned whole.  Every row of ``docs`` is reported by itself,
    whether its id is null, repeated or neither.  A containment of exactly
    MIN_CONTAINMENT suffices.  An empty table gives an empty result.  Other
    columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    keys = template_windows(spark, templates or TEMPLATES)
    masks = F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda k: F.xxhash64(F.lit("band"), k))
    # The template windows' smallest shingles, and all shingles: bound by the templates' length.
    minima = sorted({r[0] for r in keys.select(F.col("value").bitwiseXOR(F.get(masks, F.col("band")))).distinct().collect()})
    shingles = {r[0]: r[1] for r in keys.select(F.explode("shingles").alias("s")).distinct().select("s", F.xxhash64(*[F.get(F.split("s", " "), F.lit(i)) for i in range(SHINGLE)])).collect()}
    if not minima:
        return docs.select(F.col(id_col), F.lit("").alias("template"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word")).limit(0)
    places = lambda h, known: F.filter(F.transform(h, lambda x, i: F.when(x.isin(known), i)), lambda i: i.isNotNull())
    at_string = lambda w, i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(SHINGLE)])
    # Each shingle of a template that the text holds, by its string, with its first place: no more than templates have.
    held = lambda w, h: let(
        F.transform(places(h, sorted(shingles.values())), lambda i: F.struct(at_string(w, i).alias("s"), i.alias("i"))),
        lambda found: let(F.transform(found, lambda f: f["s"]), lambda all_: F.filter(F.transform(F.array_distinct(all_), lambda s: F.struct(s.alias("s"), F.get(found, (F.array_position(all_, s) - 1).cast("int"))["i"].alias("i"))), lambda f: f["s"].isin(sorted(shingles)))),
    )
    seen = let(words(F.col(text_col)), lambda w: let(shingle_hashes(w), lambda h: let(places(h, minima), lambda at: F.struct(h.alias("h"), at.alias("at"), F.when(F.size(at) > 0, held(w, h)).alias("held")))))
    near = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("__id"), seen.alias("x")).where("size(x.at) > 0").select("row", "__id", "x.*")
    # Window starts (class, offset) on the class's grid that cover such a shingle.
    starts = F.array_distinct(F.flatten(F.array(*[covering(F.col("at"), k, width, stride) for k, (width, stride, _) in enumerate(WINDOWS)])))
    width_of = F.element_at(F.array(*[F.lit(w) for w, _, _ in WINDOWS]), F.col("s.class") + 1)
    windows = near.select("row", "__id", "held", "h", F.explode(starts).alias("s")).where("s.start >= 0").select("row", "__id", "held", F.col("s.class").alias("class"), F.slice("h", F.col("s.start") + 1, width_of).alias("window")).where("size(window) > 0")
    found = windows.select("row", "__id", "held", "class", F.posexplode(minhash(F.col("window"))).alias("band", "value")).join(F.broadcast(keys), ["class", "band", "value"])
    verified = found.select("row", "__id", "template", F.size("shingles").alias("n"), F.filter("held", lambda f: F.array_contains(F.col("shingles"), f["s"])).alias("own")).where(F.size("own") >= MIN_CONTAINMENT * F.col("n"))
    return verified.groupBy("row", "__id", "template").agg(F.first(F.size("own") / F.col("n")).alias("containment"), F.first(F.array_min(F.transform("own", lambda f: f["i"]))).alias("first_word")).drop("row").withColumnRenamed("__id", id_col)
