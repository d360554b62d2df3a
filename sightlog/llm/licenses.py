"""License scans by MinHash over overlapping text windows, in DataFrame operations only.

Texts and templates are sequences of lower-case ASCII words; a shingle is 5 words.  Templates are
sorted by size into windows: a window of w shingles slides by a quarter of w (a single shingle by
one), and takes templates of at most 3/4 of w, so that some window holds any occurrence whole.
Each window has a min-hash for each of the band count of its size; a template and a window meet
when one of them is equal.  A window that holds the share MIN_SHARE of a template's shingles has
at least the similarity ``least_similarity`` with it, and the band count is chosen so that such a
pair meets with probability RECALL or more.  What met is verified by exact containment.

A regular expression first sets aside texts in which no shingle of any template occurs: no window
of theirs could be verified.  It is applied to whole texts.  The shingles of the others are dealt
into chunks of CHUNK places, each followed by as many as the widest window reaches beyond its end;
every window begins in one chunk, so time and memory grow with the text and not with its square.

The templates are a parameter and bounded: their min-hashes are broadcast after a check of
their number.

Defined results: null or empty text has no license; repeated rows, rows that share an id and rows
without id each get a row with what their own text holds; templates with fewer than 5 words are
refused.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sightlog.llm.common import bound, scratch_folder, stored, text_or_empty

SHINGLE = 5
MIN_SHARE = 0.8
RECALL = 0.999
LADDER = (1, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048)
CHUNK = 8192  # shingles; every stride divides it
MAX_TEMPLATE_BANDS = 100_000
WORD = "[A-Za-z0-9]+"

#: Notices as their licenses word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)


def least_similarity(size: int, width: int) -> float:
    """Similarity of a template of ``size`` shingles and a window that holds MIN_SHARE of them."""
    held = math.ceil(MIN_SHARE * size)
    return held / (size + width - held)


def bands(width: int) -> int:
    """Min-hashes of a window of ``width`` shingles, enough for every template it takes."""
    if width == 1:
        return 1
    sizes = range(LADDER[LADDER.index(width) - 1] * 3 // 4 + 1, width * 3 // 4 + 1)
    least = min(least_similarity(size, width) for size in sizes if width_of(size) == width)
    return math.ceil(math.log(1 - RECALL) / math.log(1 - least))


def stride(width: int) -> int:
    return max(1, width // 4)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def shingles_of(words: Column) -> Column:
    """Hash of each 5 words in a row, at its place."""

    def hashed(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(w) - SHINGLE + 1, F.lit(1)))
        return F.when(F.size(w) >= SHINGLE, F.transform(places, lambda i: F.xxhash64(F.slice(w, i, F.lit(SHINGLE))))).otherwise(
            F.array().cast("array<bigint>")
        )

    return bound(words, hashed)


def min_hashes(shingles: Column, width: int, chunk: Column | None = None) -> Column:
    """(place, width, key) of every window of ``width`` shingles, for each band; the last window
    may be shorter.

    With ``chunk`` the shingles are those of that chunk and what follows it: places count from its
    beginning, and windows are those that begin in it.
    """
    step = stride(width)
    first = F.lit(True) if chunk is None else chunk == 0
    windows_type = "array<struct<place:int,width:int,key:bigint>>"

    def of_band(band: Column) -> Column:
        mixed = F.transform(shingles, lambda h: F.xxhash64(h, band))

        def windows(m: Column) -> Column:
            # a later chunk has none where the last window begins before it
            last = F.ceil((F.size(m) - width) / F.lit(step)).cast("int")
            last = F.when(first, F.greatest(last, F.lit(0))).otherwise(last)
            if chunk is not None:
                last = F.least(last, F.lit(CHUNK // step - 1))
            one = lambda i: F.struct(
                (i * step).alias("place"), F.lit(width).alias("width"),
                F.xxhash64(F.lit(width), band, F.array_min(F.slice(m, i * step + 1, F.lit(width)))).alias("key"),
            )
            return F.when((F.size(m) > 0) & (last >= 0), F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), one)).otherwise(
                F.array().cast(windows_type)
            )

        return bound(mixed, windows)

    return F.flatten(F.transform(F.array(*[F.lit(b) for b in range(bands(width))]), of_band))


def template_words(templates) -> list[tuple[str, list[str]]]:
    split = [(name, re.findall(WORD, text.lower())) for name, text in templates]
    short = [name for name, words in split if len(words) < SHINGLE]
    if short:
        raise ValueError(f"templates with fewer than {SHINGLE} words: {short}")
    return split


def shingle_pattern(templates) -> str:
    """Matches where any of the templates' shingles stands, whatever separates its words."""
    tree: dict = {}
    for _, words in template_words(templates):
        for i in range(len(words) - SHINGLE + 1):
            node = tree
            for c in " ".join(words[i : i + SHINGLE]):
                node = node.setdefault(c, {})
            node[""] = {}

    def choice(node: dict) -> str:
        ways = [("[^A-Za-z0-9]++" if c == " " else c or "(?![A-Za-z0-9])") + choice(node[c]) for c in sorted(node)]
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})" if ways else ""

    return f"(?i)(?<![A-Za-z0-9]){choice(tree)}"


def width_of(size: int) -> int:
    """Window size, in shingles, for a template of ``size`` shingles."""
    for width in LADDER:
        if size <= width * 3 // 4 or size == width == 1:
            return width
    raise ValueError(f"a template has more than {LADDER[-1] * 3 // 4} shingles; split it")


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """template number, name, width of its windows, distinct shingles and band key, a row per band."""
    rows = []
    for i, (name, words) in enumerate(template_words(templates)):
        size = len(words) - SHINGLE + 1
        width = width_of(size)
        rows.append((i, name, width, words))
    if sum(bands(r[2]) for r in rows) > MAX_TEMPLATE_BANDS:
        raise ValueError("too many templates to broadcast; scan with parts of them")
    df = spark.createDataFrame(rows, "template int, name string, width int, words array<string>")
    shingled = df.select("template", "name", "width", F.array_distinct(shingles_of(F.col("words"))).alias("wanted"))
    keys = None
    for width in sorted({r[2] for r in rows}):
        found = F.filter(min_hashes(F.col("wanted"), width), lambda k: k["place"] == 0)
        own = shingled.where(F.col("width") == width).select("template", "name", "width", "wanted", F.explode(found).alias("k"))
        own = own.select("template", "name", "wanted", "k.key")
        keys = own if keys is None else keys.union(own)
    return keys


def chunked(shingles: Column, reach: int) -> Column:
    """(chunk, part) for each CHUNK shingles, each with ``reach`` more of those that follow."""
    part = lambda c: F.struct(c.alias("chunk"), F.slice(shingles, c * CHUNK + 1, F.lit(CHUNK + reach)).alias("part"))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(shingles) - 1) / F.lit(CHUNK)).cast("int")), part)


def licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, and findings (name, first word, last word exclusive, share) sorted, for each row.

    The words of a finding are those of the window that holds it, in numbers.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    widths = sorted({width_of(len(words) - SHINGLE + 1) for _, words in template_words(templates)})
    text = text_or_empty()
    maybe = F.when(text.rlike(shingle_pattern(templates)), shingles_of(words_of(text)))
    own = stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", maybe.alias("shingles")), folder, "shingles")
    parts = own.where(F.size("shingles") > 0).select("row", F.explode(chunked(F.col("shingles"), widths[-1])).alias("c"))
    parts = parts.select("row", "c.chunk", "c.part")
    windows = F.concat(*[min_hashes(F.col("part"), w, F.col("chunk")) for w in widths])
    keys = stored(template_table(spark, templates), folder, "templates")
    met = (
        parts.select("row", "chunk", F.explode(windows).alias("w"))
        .join(F.broadcast(keys.select("template", "key")), F.col("w.key") == F.col("key"))
        .groupBy("row", "chunk").agg(F.collect_set(F.struct("template", "w.place", "w.width")).alias("met"))
    )
    cut = F.transform("met", lambda m: F.struct(m.alias("m"), F.slice("part", m["place"] + 1, m["width"]).alias("own")))
    wanted = keys.groupBy("template").agg(F.first("name").alias("name"), F.first("wanted").alias("wanted"))
    share = F.size(F.array_intersect("wanted", "w.own")) / F.size("wanted")
    found = (
        parts.join(met, ["row", "chunk"]).select("row", "chunk", F.explode(cut).alias("w"))
        .join(F.broadcast(wanted), F.col("w.m.template") == F.col("template"))
        .select(
            "row", "name", (F.col("chunk") * CHUNK + F.col("w.m.place")).alias("place"), F.col("w.m.width").alias("width"),
            share.alias("share"),
        )
        .where(F.col("share") >= MIN_SHARE)
        .groupBy("row", "name", "place", "width").agg(F.max("share").alias("share"))
    )
    span = F.struct(
        "name", F.col("place").alias("start"), (F.col("place") + F.col("width") + SHINGLE - 1).alias("end"), "share"
    )
    by_row = found.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("findings"))
    return own.select("row", "doc_id").join(by_row, "row", "left").select(
        "doc_id",
        F.coalesce("findings", F.array().cast("array<struct<name:string,start:int,end:int,share:double>>")).alias("findings"),
    )
