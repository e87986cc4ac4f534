"""Operator 2: licence scan by sparse TF-IDF cosine, and inheritance by directory
(DataFrame functions only).

A file's licence block is its whole text if its name is that of a licence file,
else its lines that speak of a licence. Its parts are the block, each paragraph
and each run of lines around a line that speaks of a licence, so further lines
dilute no header. Parts and templates (whole licence texts, headers and opening
words) become sparse TF-IDF vectors (document frequencies counted over all
blocks); a file's licence is the template of the largest cosine to one of its
parts, if that is at least ``COSINE``. "All rights reserved" stands beside many
licences and counts only where no other licence is found. A file without a
licence of its own inherits that of the licence file in the nearest directory
above it, found by joining the prefixes of all distinct directories to the
directories that hold a licence file.

Defined results: a null text has no licence of its own; a null path inherits
nothing; ties between templates and between licence files of one directory go to
the larger cosine, then the lesser name; repeated rows are judged each; an empty
table gives an empty result.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsales.llm.common import stored

COSINE = 0.6
# Names of licence files and words of licence lines (fixed values).
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.-][^/]*)?$"
CUE = r"(?i)licen[cs]|copyright|spdx|all rights reserved|public domain|redistribution and use|permission is hereby granted"
TERM = r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"

PARAGRAPH = r"\n[^\p{L}\p{N}\n]*\n"
#: lines before and after a line that speaks of a licence
RUNS = ((0, 0), (0, 1), (1, 1), (0, 3), (3, 3), (0, 8))
RESERVED = "proprietary"

# Header lines and opening words of licence files, and whole licence texts (fixed values): (licence, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of "
                 "the License"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    *((f"CC-{code}-4.0", f"Creative Commons {name} 4.0 International Public License") for code, name in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    (RESERVED, "All rights reserved."),
    *((file.stem, file.read_text("utf-8")) for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))),
)


def _terms(text: Column) -> Column:
    return F.explode(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def blocks(files: DataFrame) -> DataFrame:
    """part_id, file_key, is_block, part: the licence block of the files that have one, and its parts."""
    text = F.col("text").cast("string")
    named = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
    lines = stored(files.where(named | text.rlike(CUE)).select("file_key", named.alias("named"), text.alias("text"),
                                                               F.split(text, "\n").alias("lines")), "license-lines")
    at = F.transform("lines", lambda line, k: F.when(line.rlike(CUE), k))
    lines = stored(lines.withColumn("cues", F.filter(at, lambda k: k.isNotNull())), "license-cues")
    block = F.when(F.col("named"), F.col("text")) \
        .otherwise(F.array_join(F.transform("cues", lambda k: F.element_at("lines", k + 1)), "\n"))
    paragraphs = F.filter(F.split("text", PARAGRAPH), lambda part: part.rlike(CUE))
    runs = F.flatten(F.transform("cues", lambda k: F.array(*[
        F.array_join(F.slice("lines", F.greatest(k - before, F.lit(0)) + 1, F.least(k, F.lit(before)) + after + 1), "\n")
        for before, after in RUNS])))
    parts = F.array_distinct(F.concat(F.array(block), paragraphs, runs))
    return stored(lines.select("file_key", F.posexplode(parts).alias("k", "part"))
                  .select(F.monotonically_increasing_id().alias("part_id"), "file_key", (F.col("k") == 0).alias("is_block"),
                          "part"), "license-parts")


def match(blocks_: DataFrame, templates=TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """file_key, license, score of the files with a part that is like a template."""
    spark = blocks_.sparkSession
    tf = stored(blocks_.select("part_id", "file_key", "is_block", _terms(F.col("part")).alias("term"))
                .groupBy("part_id", "file_key", "is_block", "term").agg(F.count(F.lit(1)).alias("tf")), "license-terms")
    n_blocks = tf.where("is_block").select("part_id").distinct().count()
    df = stored(tf.where("is_block").groupBy("term").agg(F.count(F.lit(1)).alias("df")), "license-df")
    idf = F.log((n_blocks + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    weighted = stored(tf.join(df, "term", "left").select("part_id", "file_key", "term", (F.col("tf") * idf).alias("w")),
                      "license-weights")
    norms = weighted.groupBy("part_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))

    known = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)],
                                  "template int, license string, body string")
    known = known.select("template", "license", _terms(F.col("body")).alias("term")) \
        .groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = known.join(df, "term", "left").select("template", "license", "term", (F.col("tf") * idf).alias("tw"))
    known = stored(known, "license-templates")
    lengths = known.groupBy(F.col("template").alias("t")).agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("t_norm"))
    known = known.join(F.broadcast(lengths), F.col("template") == F.col("t")).drop("t")
    # the template terms are a fixed list of a few thousand rows
    dots = weighted.join(F.broadcast(known), "term").groupBy("part_id", "file_key", "template", "license", "t_norm") \
        .agg(F.sum(F.col("w") * F.col("tw")).alias("dot")).join(norms, "part_id")
    # rounded, so that the order of summation decides nothing
    score = F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 9)
    choice = F.struct((F.col("license") == RESERVED).alias("reserved"), (-score).alias("s"), "license")
    best = dots.where(score >= cosine).groupBy("file_key").agg(F.min(choice).alias("b"))
    return best.select("file_key", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def parent(path: Column) -> Column:
    """The directory of a path: what stands before its last slash ('' for the root)."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, templates=TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """file_key, path, own_license, own_score, inherited_license, inherited_from, license
    of rows file_key, path, text."""
    files = files.select("file_key", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    own = stored(match(blocks(files), templates, cosine), "license-own") \
        .select(F.col("file_key").alias("k"), F.col("license").alias("own_license"), F.col("score").alias("own_score"))
    judged = stored(files.select("file_key", "path").join(own.dropDuplicates(["k"]), F.col("file_key") == F.col("k"), "left")
                    .drop("k").withColumn("dir", parent(F.col("path"))), "license-files")
    holders = judged.where(F.col("own_license").isNotNull() & F.col("path").rlike(FILE_NAME)) \
        .groupBy(F.col("dir").alias("above")) \
        .agg(F.min(F.struct((-F.col("own_score")).alias("s"), "own_license")).alias("b")) \
        .select("above", F.col("b.own_license").alias("held"))
    # every distinct directory with itself and all directories above it, nearest first
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    dirs = judged.where("dir IS NOT NULL").select("dir").distinct()
    nearest = dirs.select("dir", F.posexplode(above).alias("depth", "above")).join(holders, "above") \
        .groupBy("dir").agg(F.max(F.struct("depth", "above", "held")).alias("b")) \
        .select("dir", F.col("b.held").alias("inherited_license"), F.col("b.above").alias("inherited_from"))
    return judged.join(stored(nearest, "license-dirs"), "dir", "left") \
        .select("file_key", "path", "own_license", "own_score", "inherited_license", "inherited_from",
                F.coalesce("own_license", "inherited_license").alias("license"))
