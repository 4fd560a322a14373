"""Licence scans by sparse TF-IDF cosine to templates, and inheritance from ancestor directories.

Every run of up to WINDOW lines or sentences of every text (so that a notice may be wrapped), every short text as a whole, and
every text that may be like a full licence text as a whole, is a unit. Its vector has its terms,
each weighted by its inverse document frequency over all documents. Vectors meet in a join on terms, so only
those that share one with a template are scored, first with the least weight for terms outside the templates; the
frequencies of those terms are joined to the units that may then reach the threshold. Units that cannot reach the threshold are dropped before: a template's cosine is
at most the norm of the terms shared with it over its own norm, so a unit must have one of the template's weightiest
terms. A file's licence is that of the full text which it is like, or else its best unit's. A file that is mostly licence text is a licence file; it speaks for the files without a licence of
their own below its directory, the nearest such directory first. All of it runs in built-in functions.

Defined cases: a null or empty text has no licence of its own; a null path has no ancestors; of equal cosines the
longer template wins, then the first in TEMPLATES; of several licence files in one directory the highest share of licence text, then the smallest
id; repeated and null ids are rows each, with their own text's licence; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

#: Notices by which works are commonly licensed, with a short name for each licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    *((name, f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, "
       f"either version {version} of the License, or (at your option) any later version.")
      for name, what, kind, version in (("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"), ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "library", "Lesser ", "3"), ("AGPL-3.0", "program", "Affero ", "3"))),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Full texts with the licence's short name as file name, read by the driver.
FULL_TEXTS = tuple((p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))
THRESHOLD, FILE_SHARE = 0.8, 0.3
#: Directories with a licence that may be broadcast; beyond it the join shuffles.
BROADCAST_DIRECTORIES = 50_000
#: Terms with their frequencies that may be broadcast to the units that may reach the threshold.
BROADCAST_TERMS = 200_000
_SPLIT, _UNITS = r"[^\p{L}\p{N}]+", r"\n|(?<=[.!?])\s"
WHOLE_TERMS = 60
#: Lines or sentences that a notice may be wrapped over.
WINDOW = 6


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda t: t != "")


def counted_terms(text: str) -> dict[str, int]:
    return dict(Counter(re.findall(r"[^\W_]+", text.lower())))


def template_terms() -> list[dict[str, int]]:
    return [counted_terms(text) for _, text in TEMPLATES]


def full_terms() -> list[dict[str, int]]:
    return [counted_terms(text) for _, text in FULL_TEXTS]


def document_frequencies(files: DataFrame) -> tuple[int, DataFrame]:
    """Of all files the number, and t, n of every term that more than one file has, or one and a template (a saved table)."""
    known = sorted({t for x in template_terms() + full_terms() for t in x})
    found = files.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("t"))
    return files.count(), saved(found.groupBy("t").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("t").isin(known)), "licences-terms")


def weights(n: int, counts: dict[str, int]) -> tuple[dict[str, float], float]:
    """Inverse document frequencies of the templates' terms, and that of a term that one document has."""
    idf = lambda k: math.log((1 + n) / (1 + k)) + 1
    return {t: idf(counts.get(t, 0)) for x in template_terms() for t in x}, idf(1)


def frequency_weights(n: int, of: list[str], counts: dict[str, int]) -> dict[str, float]:
    return {t: math.log((1 + n) / (1 + counts.get(t, 0))) + 1 for t in of}


def least_shared(x: dict[str, int], idf: dict[str, float], threshold: float) -> int:
    """How many of a template's terms a text must have at least to reach the threshold."""
    square = sorted(((c * idf[t]) ** 2 for t, c in x.items()), reverse=True)
    least, total = threshold**2 * sum(square) * (1 - 1e-9), 0.0
    for n, w in enumerate(square, 1):
        total += w
        if total >= least:
            return n
    return len(square)


def needed_of(templates: list[dict[str, int]], idf: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a unit must have one to reach the threshold with any of the templates."""
    need = set()
    for x in templates:
        square = {t: (c * idf[t]) ** 2 for t, c in x.items()}
        left = sum(square.values())
        least = threshold**2 * left * (1 - 1e-9)
        for t in sorted(square, key=lambda t: (-square[t], t)):
            if left < least:
                break
            need.add(t)
            left -= square[t]
    return sorted(need)


def needed_terms(idf: dict[str, float], threshold: float = THRESHOLD) -> list[str]:
    """Terms of which a line, a window or a short text must have one."""
    return needed_of(template_terms(), idf, threshold)


def own_licences(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """id, licence, similarity, share: the best template of each file that reaches the threshold.

    files: id, text; rows of one id must have one text, and count as often as they are there. share: what part of the file's terms lies in units that reach it.
    """
    spark = files.sparkSession
    total, frequencies = document_frequencies(files)
    own_terms = sorted({t for x in template_terms() + full_terms() for t in x})
    idf = frequency_weights(total, own_terms, {r.t: r.n for r in frequencies.where(F.col("t").isin(own_terms)).collect()})
    need = needed_terms(idf, threshold)
    needed = F.array(*map(F.lit, need))
    pieces = F.filter(F.transform(F.split("text", _UNITS), terms), lambda t: F.size(t) > 0)
    read = files.select("id", pieces.alias("pieces"))
    of_pieces = F.size("pieces")
    hits = F.filter(F.sequence(F.lit(0), of_pieces - 1), lambda i: F.arrays_overlap(F.get("pieces", i), needed))
    hits = F.when(of_pieces > 0, hits).otherwise(F.array().cast("array<int>"))
    read = read.select("id", "pieces", hits.alias("hits"), F.flatten("pieces").alias("ts"))

    def around(h: Column) -> Column:
        """The windows that hold a piece: first piece and number of pieces."""
        firsts = lambda m: F.filter(F.sequence(F.greatest(F.lit(0), h - m + 1), h), lambda s: s + m <= F.size("pieces"))
        return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(WINDOW)), lambda m: F.transform(firsts(m), lambda s: F.struct(s.alias("s"), m.alias("m")))))

    windows = F.array_distinct(F.flatten(F.transform("hits", around)))
    own = lambda w: F.slice("pieces", w["s"] + 1, w["m"])
    unit_of = lambda w: F.struct((w["s"].cast("long") * (WINDOW + 1) + w["m"]).alias("unit"), F.lit(False).alias("whole"), F.transform(own(w), lambda t: F.size(t)).alias("sizes"), F.flatten(own(w)).alias("ts"))
    fits = F.lit(False)
    for x in full_terms():
        m = least_shared(x, idf, threshold)
        heavy = F.array(*map(F.lit, needed_of([x], idf, threshold)))
        fits = fits | ((F.size("ts") >= m) & F.arrays_overlap("ts", heavy) & (F.size(F.array_intersect("ts", F.array(*map(F.lit, sorted(x))))) >= m))
    is_whole = ((F.size("ts") <= WHOLE_TERMS) & (F.size("hits") > 0)) | fits
    whole = F.struct(F.lit(0).cast("long").alias("unit"), F.lit(True).alias("whole"), F.array(F.size("ts")).alias("sizes"), F.col("ts"))
    units = read.select("id", F.size("ts").alias("size"), F.explode_outer(F.concat(F.transform(windows, unit_of), F.when(is_whole, F.array(whole)).otherwise(F.array().cast("array<struct<unit:bigint,whole:boolean,sizes:array<int>,ts:array<string>>>")))).alias("u"))
    units = units.where(F.col("u").isNotNull()).select("id", "size", "u.*")
    counted = units.select("id", "unit", "size", "whole", F.col("sizes").alias("n"), F.explode("ts").alias("t")).groupBy("id", "unit", "size", "whole", "n", "t").agg(F.count("*").alias("c"))
    vectors = []
    for k, x in enumerate(template_terms() + full_terms()):
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in x.items()))
        vectors += [(t, k, k >= len(TEMPLATES), c * idf[t] * idf[t] / norm) for t, c in x.items()]
    template = spark.createDataFrame(vectors, "t string, k int, full boolean, w double")
    known = spark.createDataFrame(sorted(idf.items()), "t string, idf double")
    counted = counted.join(F.broadcast(known), "t", "left")  # as many rows as the templates have terms
    unit = ["id", "unit", "size", "whole", "n"]
    is_known = F.col("idf").isNotNull()
    vectors = counted.groupBy(unit).agg(
        F.sum(F.when(is_known, F.pow(F.col("c") * F.col("idf"), 2)).otherwise(0.0)).alias("square"), F.sum(F.when(is_known, 0).otherwise(F.col("c") * F.col("c"))).alias("least"),
        F.collect_list(F.when(is_known, F.struct("t", "c"))).alias("x"), F.collect_list(F.when(~is_known, F.struct("t", "c"))).alias("others"),
    )
    vectors = saved(vectors, "licences-vectors")
    dots = vectors.select(*unit, "square", "least", F.inline("x")).join(F.broadcast(template), "t").where(F.col("whole") | ~F.col("full"))
    dots = dots.groupBy(*unit, "k").agg(F.sum(F.col("c") * F.col("w")).alias("dot"), F.first("square").alias("square"), F.first("least").alias("least"))
    # no weight is less than 1
    dots = saved(dots.where(F.col("dot") >= (threshold - 1e-6) * F.sqrt(F.col("square") + F.col("least"))).join(vectors.select(*unit, "others"), unit), "licences-units")
    others = saved(dots.select(F.inline("others")).select("t").distinct(), "licences-others")
    few = others.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    others = frequencies.withColumnRenamed("n", "files").join(F.broadcast(others) if few else others, "t", "left_semi")
    parts = dots.select(*unit, "k", "dot", "square", F.inline_outer("others")).join(F.broadcast(others) if few else others, "t", "left")
    rest = F.pow(F.col("c") * (F.log((1 + total) / (1 + F.coalesce(F.col("files"), F.lit(1)))) + 1), 2)
    scored = parts.groupBy(*unit, "k").agg(F.round(F.first("dot") / F.sqrt(F.first("square") + F.coalesce(F.sum(rest), F.lit(0.0))), 9).alias("cosine")).where(F.col("cosine") >= threshold)
    lengths = F.array(*[F.lit(sum(x.values())) for x in template_terms() + full_terms()])
    rank = F.struct((F.col("k") >= len(TEMPLATES)).alias("full"), "cosine", F.get(lengths, F.col("k")).alias("length"), (-F.col("k")).alias("k"))
    best = scored.groupBy("id", "unit", "size", "whole", "n").agg(F.max(rank).alias("b"))
    # the pieces of windows that reach the threshold count once each
    first = F.floor(F.col("unit") / (WINDOW + 1)).cast("int")
    parts = F.when(F.col("whole"), F.array(F.struct(F.lit(-1).alias("at"), F.get("n", F.lit(0)).alias("n")))).otherwise(F.transform("n", lambda x, i: F.struct((first + i).alias("at"), x.alias("n"))))
    per = best.groupBy("id", "size").agg(F.max("b").alias("b"), F.array_distinct(F.flatten(F.collect_list(parts))).alias("parts"))
    names = F.array(*[F.lit(x) for x, _ in TEMPLATES + FULL_TEXTS])
    covered = F.aggregate("parts", F.lit(0), lambda a, p: a + p["n"])
    share = F.least(F.lit(1.0), covered / F.col("size"))
    return per.select("id", F.get(names, -F.col("b.k")).alias("licence"), F.col("b.cosine").alias("similarity"), share.alias("share"))


def row_key(doc_id: Column, text: Column) -> Column:
    """The same for rows of the same id and text alone: 128 bits of hashes."""
    parts = (F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("/"), F.coalesce(text, F.lit("")))
    return F.concat(F.hex(F.xxhash64(F.lit(1), *parts)), F.lit("-"), F.hex(F.xxhash64(F.lit(2), *parts)))


def directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """A directory and all above it, the root ('') last."""
    parts = F.split(folder, "/")
    n = F.size(parts)
    return F.transform(F.sequence(n, F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def licences(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """id, path, licence, similarity, origin (own, inherited, none), licence_path of every file.

    files: id, path, text. Ids may repeat or be null: own licences are found by id and text together. Directories, not files, meet their ancestors.
    """
    keyed = files.withColumn("key", row_key(F.col("id"), F.col("text")))
    own = saved(own_licences(keyed.select(F.col("key").alias("id"), "text"), threshold), "licences-own").withColumnRenamed("id", "key")
    all_ = keyed.select("id", "key", "path", directory(F.col("path")).alias("folder"))
    named = all_.join(own, "key", "left").drop("key")
    named = saved(named, "licences-named")
    w = Window.partitionBy("folder").orderBy(F.desc("share"), "id")
    speaks = named.where((F.col("share") >= FILE_SHARE) & F.col("folder").isNotNull()).withColumn("nth", F.row_number().over(w)).where("nth = 1")
    speaks = saved(speaks.select(F.col("folder").alias("above"), F.col("licence").alias("from_licence"), F.col("path").alias("licence_path"), F.col("similarity").alias("from_similarity")), "licences-speak")
    folders = named.select("folder").where("folder is not null").distinct()
    meets = folders.select("folder", F.posexplode(ancestors(F.col("folder"))).alias("up", "above")).join(speaks, "above")
    near = meets.groupBy("folder").agg(F.min_by(F.struct("from_licence", "from_similarity", "licence_path"), "up").alias("f"))
    near = saved(near.select("folder", "f.from_licence", "f.from_similarity", "f.licence_path"), "licences-near")
    few = near.limit(BROADCAST_DIRECTORIES + 1).count() <= BROADCAST_DIRECTORIES
    both = named.join(F.broadcast(near) if few else near, "folder", "left")
    is_own = F.col("licence").isNotNull()
    return both.select(
        "id", "path", F.coalesce("licence", "from_licence").alias("licence"),
        F.when(is_own, F.col("similarity")).otherwise(F.col("from_similarity")).alias("similarity"),
        F.when(is_own, "own").when(F.col("from_licence").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(is_own, F.col("path")).otherwise(F.col("licence_path")).alias("licence_path"),
    )


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files source/lang/doc_id, whose licences are found or inherited; a null part is an empty name."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.lit(""), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "doc_id")])
    files = docs.select(F.col("doc_id").cast("long").alias("id"), path.alias("path"), F.col("text").cast("string").alias("text"))
    return licences(files).withColumnRenamed("id", "doc_id")
