"""License scans: MinHash bands over text windows retrieve templates, shingles verify them.

Texts and templates are lower-cased runs of ASCII letters and digits; a shingle is five of them
in a row. For a template of m shingles, texts are cut into overlapping windows of
m + ceil(m / 2) shingles, every floor(m / 2) + 1, so that any m shingles in a row lie inside a
window. A window and a template that it holds to the share c have a Jaccard similarity of at
least c m / (m + ceil(m / 2) + (1 - c) m), 0.47 at the limit c = 0.8, and 0.5 or more if it
holds all. ``BANDS`` bands of ``ROWS`` minimum hashes then meet with a chance above 99.8 %.
Retrieved pairs are verified exactly: the share of the template's shingles in the window.

Windows without any shingle of the templates cannot hold one and are not hashed; that loses
nothing. Only Spark SQL functions are used. Templates are a fixed list, so the joins with their
bands and shingles are bounded broadcasts.

Defined cases: a null or empty text, or one of fewer than five such words, matches nothing; a
null doc_id is an id; rows that share a doc_id are reported once, with their best match; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilcard.llm.common import stage, text_or_empty

SHINGLE, ROWS, BANDS = 5, 2, 28
LIMIT = 0.8
#: Public license notices.
TEMPLATES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
    "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def shingle_hashes(text: Column) -> Column:
    """Hashes of the shingles in order; empty below five words."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0)
    each = F.transform(F.array(words), lambda w: F.when(F.size(w) >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))))))[0]
    return F.coalesce(each, F.array().cast("array<bigint>"))


def band_hashes(shingles: Column) -> Column:
    """One hash per band of minimum hashes."""
    least = lambda j: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, j)))
    signature = F.transform(F.sequence(F.lit(0), F.lit(ROWS * BANDS - 1)), least)
    return F.transform(F.array(signature), lambda s: F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, *(F.get(s, b * ROWS + r) for r in range(ROWS)))))[0]


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license, m (distinct shingles), own (their hashes)."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    return rows.select("license", F.array_distinct(shingle_hashes(F.col("text"))).alias("own")).select(
        "license", F.size("own").alias("m"), "own").where("m > 0")


def windows(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Overlapping windows for templates of each length: m, start, window."""
    rows = rows.withColumn("m", F.explode(F.array(*map(F.lit, lengths))))
    width, step = F.col("m") + F.ceil(F.col("m") / 2).cast("int"), F.floor(F.col("m") / 2).cast("int") + 1
    last = F.greatest(F.size("shingles") - 1, F.lit(0))
    rows = rows.withColumn("start", F.explode(F.sequence(F.lit(0), last, step)))
    return rows.withColumn("window", F.slice("shingles", F.col("start") + 1, width)).drop("shingles")


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES, limit: float = LIMIT) -> DataFrame:
    """One row per document and license found: doc_id, license, share (of the template's
    shingles in the best window), n_windows (that hold it), first_word (of the first one)."""
    spark = documents.sparkSession
    table = template_table(spark, templates)
    known = {r["license"]: (r["m"], list(r["own"])) for r in table.collect()}
    every = sorted({h for _, own in known.values() for h in own})
    universe = F.lit(every).cast("array<bigint>") if every else F.array().cast("array<bigint>")
    rows = documents.select("doc_id", shingle_hashes(text_or_empty()).alias("shingles"))
    rows = stage(rows.where(F.arrays_overlap("shingles", universe)), "license-candidates")
    cut = windows(rows, sorted({m for m, _ in known.values()}) or [1]).where(F.arrays_overlap("window", universe))
    bands = F.broadcast(table.select("m", "license", F.posexplode(band_hashes(F.col("own"))).alias("band", "hash")))
    met = cut.select("*", F.posexplode(band_hashes(F.col("window"))).alias("band", "hash")).join(bands, ["m", "band", "hash"])
    met = met.groupBy("doc_id", "license", "start").agg(F.first("window").alias("window"))
    sure = met.join(F.broadcast(table.select("license", "own", F.col("m"))), "license").withColumn(
        "share", F.size(F.array_intersect("window", "own")) / F.col("m")).where(F.col("share") >= limit)
    return sure.groupBy("doc_id", "license").agg(
        F.max("share").alias("share"), F.count("*").alias("n_windows"), F.min("start").cast("long").alias("first_word"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: licenses named in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    """Exact containment of every template in every window, without hashes."""
    values = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES.items())
    cut = "list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i : i + 4], ' '))"
    return f"""
WITH templates AS (
  SELECT license, list_distinct({cut}) AS own
  FROM (SELECT license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM (VALUES {values}) AS t(license, text))
), wanted AS (
  SELECT list(DISTINCT s) AS every FROM (SELECT unnest(own) AS s FROM templates)
), texts AS (
  SELECT doc_id, {cut} AS shingles
  FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents)
), candidates AS (
  SELECT doc_id, shingles FROM texts, wanted WHERE list_has_any(shingles, every)
), windows AS (
  SELECT doc_id, license, own, len(own) AS m, shingles,
         unnest(range(0, len(shingles), len(own) // 2 + 1)) AS start FROM candidates, templates
), shares AS (
  SELECT doc_id, license, start,
         len(list_intersect(own, shingles[start + 1 : start + m + (m + 1) // 2])) / m AS share FROM windows
)
SELECT doc_id, license, max(share) AS share, count(*) AS n_windows, min(start) AS first_word
FROM shares WHERE share >= {LIMIT} GROUP BY doc_id, license"""
