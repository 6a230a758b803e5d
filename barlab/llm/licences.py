"""Licence scan with DataFrame functions only.

1. Licence templates, short notices and the openings of licence texts, become
   sparse TF-IDF vectors. The document frequencies are those of all files, so
   words that any prose holds weigh little.
2. A line (a header is one) has the cosine of its own vector over the templates'
   words with each template; the best one of at least ``LEAST`` is its licence.
   Words that weigh so little that they cannot reach ``LEAST`` by themselves do
   not make a file a candidate; that bound is exact (by Cauchy-Schwarz), and
   only files with one of the other words are looked at line by line.
3. A licence file is one by name, or one at least half of whose words lie in
   licence lines. It covers its directory: a file without a licence of its own
   inherits from the nearest directory above it that has a licence file. All
   ancestors of each directory are joined with the directories that have one.

The templates are a fixed table, so all their joins are broadcast. A directory
with very many files is one row on the directory side of its join.

Nulls: a file with a null path has no directory and inherits nothing; a null or
empty text has no licence of its own. Rows are told apart by path and text;
repeated rows get equal results. Equal scores prefer the first licence by name,
and in a directory the first file by path. An empty table gives an empty one;
further columns are read only if they are to be kept. Texts of any length are
split whole, into lines, by one task each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

LEAST = 0.6
BROADCAST_ROWS = 2_000_000

# The wording of licence notices, by licence.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License. You may obtain a copy of the "
                   "License at"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation; either version 2 of the License, or (at your option) any later "
                "version"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
LICENCE_FILES = ("license", "licence", "copying", "notice", "unlicense")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _counts(words: list[str]) -> dict[str, int]:
    return {w: words.count(w) for w in words}


def _template_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _vectors(frequency: dict[str, int], files: int) -> list[tuple[int, str, dict[str, float]]]:
    """(number, licence, unit vector) of each template."""
    vectors = []
    for number, (licence, text) in enumerate(TEMPLATES):
        weights = {
            word: (1 + math.log(times)) * _weight(frequency.get(word, 0), files)
            for word, times in _counts(_template_words(text)).items()
        }
        norm = math.sqrt(sum(w * w for w in weights.values()))
        vectors.append((number, licence, {w: v / norm for w, v in weights.items()}))
    return vectors


def _weight(frequency: int, files: int) -> float:
    return 1 + math.log((1 + files) / (1 + frequency))


def _telling(vectors, least: float) -> list[str]:
    """Words of which a line with a cosine of ``least`` has at least one."""
    telling = set()
    for _, _, vector in vectors:
        rest = least * least * (1 - 1e-9)
        for word, value in sorted(vector.items(), key=lambda item: (item[1], item[0])):
            rest -= value * value
            if rest <= 0:
                telling.add(word)
    return sorted(telling)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def licence_lines(files: DataFrame, least: float = LEAST) -> DataFrame:
    """(path, text_hash, line, licence, score, line_words, file_words) of lines with a licence."""
    spark = files.sparkSession
    keyed = files.select(
        F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    vocabulary = sorted({w for _, text in TEMPLATES for w in _template_words(text)})
    known = F.array(*(F.lit(w) for w in vocabulary))
    outline = written(
        keyed.withColumn("words", _words(F.col("text"))).select(
            "path", "text_hash", F.size("words").alias("file_words"),
            F.coalesce(
                F.array_intersect("words", known), F.array().cast("array<string>")
            ).alias("terms"),
        ),
        "licence-outlines",
    )
    total = outline.count()
    # At most one row per word of the templates.
    frequency = {
        r.term: r.files for r in outline.select(F.explode("terms").alias("term"))
        .groupBy("term").agg(F.count("*").alias("files")).collect()
    }
    vectors = _vectors(frequency, total)
    telling = F.array(*(F.lit(w) for w in _telling(vectors, least)))
    candidates = written(
        outline.filter(F.arrays_overlap("terms", telling))
        .select("path", "text_hash", "file_words").distinct(),
        "licence-candidates",
    )
    weights = F.broadcast(spark.createDataFrame(
        [(w, _weight(frequency.get(w, 0), total)) for w in vocabulary], "term string, idf double"
    ))
    templates = F.broadcast(spark.createDataFrame(
        [(n, licence, w, v) for n, licence, vector in vectors for w, v in vector.items()],
        "template int, licence string, term string, value double",
    ))
    lines = keyed.alias("k").join(
        _small(candidates).alias("c"),
        F.col("k.path").eqNullSafe(F.col("c.path"))
        & F.col("k.text_hash").eqNullSafe(F.col("c.text_hash")),
    ).select(
        "k.path", "k.text_hash", "file_words",
        F.posexplode(F.split(F.col("text"), "[\\n\\r]+")).alias("line", "said"),
    ).distinct().withColumn("words", _words(F.col("said"))).filter(
        F.arrays_overlap("words", telling)
    )
    key = ["path", "text_hash", "file_words", "line", "line_words"]
    terms = (
        lines.select(
            "path", "text_hash", "file_words", "line", F.size("words").alias("line_words"),
            F.explode("words").alias("term"),
        )
        .groupBy(*key, "term").agg(F.count("*").alias("times"))
        .join(weights, "term")
        .withColumn("value", (1 + F.log("times")) * F.col("idf"))
    )
    norms = terms.groupBy(*key).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    dots = (
        terms.withColumnRenamed("value", "own").join(templates, "term")
        .groupBy(*key, "template", "licence")
        .agg(F.sum(F.col("own") * F.col("value")).alias("dot"))
    )
    same = F.lit(True)
    for column in key:
        same = same & F.col(f"d.{column}").eqNullSafe(F.col(f"n.{column}"))
    scored = dots.alias("d").join(norms.alias("n"), same).select(
        *(F.col(f"d.{c}").alias(c) for c in key), "licence",
        F.round(F.col("dot") / F.col("norm"), 9).alias("score"),
    ).filter(F.col("score") >= least)
    return scored.groupBy(*key).agg(
        F.min_by("licence", F.struct(-F.col("score"), "licence")).alias("licence"),
        F.max("score").alias("score"),
    )


def _directory(path: Column) -> Column:
    """The path up to its last slash; the root is empty."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, least: float = LEAST, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``files`` (path, text): path, text_hash, licence, origin, score, licence_file.

    ``origin`` is ``header`` for a licence of its own, ``inherited``, or null.
    ``keep`` names further columns of ``files`` to be led by.
    """
    lines = written(licence_lines(files, least), "licence-lines")
    own = written(
        lines.groupBy("path", "text_hash").agg(
            F.min_by("licence", F.struct(-F.col("score"), "licence")).alias("licence"),
            F.max("score").alias("score"), F.sum("line_words").alias("said"),
            F.max("file_words").alias("file_words"),
        ),
        "own-licences",
    )
    name = F.lower(F.regexp_replace(F.regexp_extract("path", "[^/]*$", 0), "\\..*$", ""))
    covering = own.filter(
        F.col("path").isNotNull()
        & (name.isin(*LICENCE_FILES) | (2 * F.col("said") >= F.col("file_words")))
    ).groupBy(_directory(F.col("path")).alias("covered")).agg(
        F.min_by(F.struct("path", "licence", "score"), F.struct(-F.col("score"), "path")).alias("by")
    )
    directories = (
        files.select(_directory(F.col("path").cast("string")).alias("directory"))
        .filter("directory is not null").distinct()
    )
    parts = F.array_remove(F.split("directory", "/"), "")
    # The root and every directory on the way, as far as the directory itself.
    above = directories.withColumn("parts", parts).select("directory", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("parts")),
        lambda depth: F.struct(depth.alias("depth"), F.when(
            depth == F.size("parts"), F.col("directory")
        ).otherwise(F.concat(
            F.when(F.col("directory").startswith("/") & (depth > 0), "/").otherwise(""),
            F.array_join(F.slice("parts", F.lit(1), depth), "/"),
        )).alias("covered")),
    )).alias("step")).select("directory", "step.*")
    nearest = above.join(covering, "covered").groupBy("directory").agg(
        F.max_by("by", "depth").alias("by")
    )
    led = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    rows = files.select(
        *led, F.col("path").cast("string").alias("path"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    ).withColumn("directory", _directory(F.col("path")))
    with_own = rows.alias("r").join(
        _small(own).alias("o"),
        F.col("r.path").eqNullSafe(F.col("o.path"))
        & F.col("r.text_hash").eqNullSafe(F.col("o.text_hash")),
        "left",
    ).select("r.path", "r.text_hash", "directory", "licence", "score",
             *(f"kept_{i}" for i in range(len(keep))))
    return with_own.join(nearest, "directory", "left").select(
        *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)), "path", "text_hash",
        F.coalesce("licence", "by.licence").alias("licence"),
        F.when(F.col("licence").isNotNull(), "header")
        .when(F.col("by").isNotNull(), "inherited").alias("origin"),
        F.coalesce("score", "by.score").alias("score"),
        F.when(F.col("licence").isNull(), F.col("by.path")).alias("licence_file"),
    )
