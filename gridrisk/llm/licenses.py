"""License scans with DataFrame functions only: MinHash bands over overlapping text windows.

Words are what lies between ASCII marks and blanks, lower-cased; a shingle is five of them. Windows of a document are WIDTH
shingles long and begin at every STRIDE-th shingle; a template has windows at every shingle. A window has BANDS bands of
ROWS minwise tokens each (least of the shingle hashes under a keyed flip of their bits); equal bands of a document's and a template's
window retrieve the template, and a match is a template with at least CONTAINED of its shingles in the document.

Windows follow the template's length, so that the retrieval is sure when words are inserted, deleted or replaced: the least number of shingles that stay in one piece when a fifth
of a template's m shingles go (an inserted word takes four) holds a whole window at each stride, and then all bands agree. (It isn't sure for a text that repeats words at each
break, so that a cut costs fewer than four shingles: 80 % can stay there without one whole window; such windows are retrieved with the probability below.)

| m from | WIDTH | STRIDE | shingles in one piece needed | left in one piece, at least |
| 40 | 8 | 4 | 11 | 0.8 m / (m / 20 + 1), 11 at m = 40 |
| 10 | 4 | 2 | 5 | 8 |
| 2 | 2 | 1 | 2 | 4 (m = 5), m (m < 5) |
| 1 | 1 | 1 | 1 | 1 |

Windows that differ too are retrieved by 1 - (1 - J**ROWS)**BANDS: 0.87 at J = 0.8, 0.44 at 0.5 (each window).

Templates are a table of any size: band keys are joined to the documents' (by broadcast up to KEYS of them, else by shuffle, after
distinct keys of a document), candidates then get their texts, by a scan that reads candidates' rows only, and their templates.

Defined results: null and empty texts and those of under five words match nothing, nor do
templates of under five words or without text; very long texts are read whole. Several templates may match one document, each is reported.
Repeated rows give repeated matches. Ids may be null and are returned as they are. An empty table gives no matches. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridrisk.llm.textops import stored

BANDS, ROWS, CONTAINED = 2, 2, 0.8
#: (shingles of a template from which they hold, WIDTH, STRIDE)
WINDOWS = ((1, 1, 1), (2, 2, 1), (10, 4, 2), (40, 8, 4))
#: Keys and templates that are broadcast; candidates are told to the second scan as hashes of ID_HASHES values.
KEYS, TEMPLATES, ID_HASHES = 1_000_000, 2000, 1 << 20
_MASK = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Notices by which public licenses are named, and parts of their texts.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-disclaimer", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT-warranty", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
)


def _words(text: Column) -> Column:
    """Hashes of the words."""
    return F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _MASK), ""), lambda w: F.xxhash64(w))


def _shingles(words: Column) -> Column:
    """Distinct shingles of an array of word hashes."""
    return F.when(F.size(words) < 5, F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(words) - 5), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(5))))))


def _flip(i: int) -> int:
    """Bits by which the i-th order of hashes differs (odd multiples of the golden ratio's fraction, as a signed long)."""
    return ((2 * i + 1) * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63)


def _keys(width: int, starts: Column, bands: int) -> list[Column]:
    """The band keys of the window of so many shingles that starts in this row; null where there is none."""
    least = [F.least(*(F.col(f"_g{j}").bitwiseXOR(F.lit(_flip(i))) for j in range(max(width, 2)))) if width > 1 else F.col("_g0").bitwiseXOR(F.lit(_flip(i))) for i in range(bands * ROWS)]
    return [F.when((F.col("_n") >= width) & starts, F.xxhash64(F.lit(width), F.lit(b), *least[b * ROWS : (b + 1) * ROWS])) for b in range(bands)]


def _rows(df: DataFrame, words: str, width: int, *keep: str) -> DataFrame:
    """A row for each word, with its place _at and the shingles from it on, as many as a window has."""
    shifted = F.arrays_zip(*(F.slice(words, F.lit(j + 1), F.size(words)).alias(f"w{j}") for j in range(width + 4)))
    rows = df.where(F.size(words) >= 5).select(*keep, F.posexplode(shifted).alias("_at", "_z"))
    rows = rows.select(*keep, "_at", *(F.col("_z").getField(f"w{j}").alias(f"_w{j}") for j in range(width + 4)))
    # _g0.. are never null, _n counts those that are there: simpler code in the key expressions
    there = sum(F.col(f"_w{j}").isNotNull().cast("int") for j in range(1, width + 4))
    return rows.select(*keep, "_at", (there - F.lit(3)).alias("_n"), *(F.xxhash64(*(F.coalesce(f"_w{j + k}", F.lit(0)) for k in range(5))).alias(f"_g{j}") for j in range(width)))


def license_matches(docs: DataFrame, templates: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "license", body: str = "text", bands: int = BANDS, contained: float = CONTAINED) -> DataFrame:
    """doc_id, license, n_template, n_found: every template that a document holds."""
    known = templates.select(F.col(name).alias("license"), _words(F.col(body)).alias("words")).withColumn("grams", _shingles(F.col("words"))).where(F.size("grams") > 0)
    known = stored(known.withColumn("t", F.monotonically_increasing_id()), "license-templates")
    of = F.size("words") - 4
    scales = [(least, width, stride) for least, width, stride in WINDOWS if not known.where((of >= least) & (F.lit(True) if (least, width, stride) == WINDOWS[-1] else of < next(x for x, _, _ in WINDOWS if x > least))).isEmpty()]
    if not scales:
        return docs.select(F.col(doc_id).alias("doc_id")).limit(0).select("doc_id", F.lit("").alias("license"), F.lit(0).cast("long").alias("n_template"), F.lit(0).cast("long").alias("n_found"))
    widest = scales[-1][1]
    own = F.greatest(*(F.when(F.col("n") >= least, F.lit(width)) for least, width, _ in WINDOWS), F.lit(0))
    rows = _rows(known.withColumn("n", of), "words", widest, "t", "n").withColumn("own", own)
    mine = F.array(*(k for _, width, _ in scales for k in _keys(width, F.col("own") == width, bands)))
    keys = stored(rows.select("t", F.explode(mine).alias("key")).where("key is not null").distinct(), "license-keys")
    small = keys.count() <= KEYS

    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("x"), F.col(text).alias("body"))
    rows = _rows(texts.select("doc_id", "x", _words(F.col("body")).alias("words")), "words", widest, "doc_id", "x")
    every = F.array(*(k for _, width, stride in scales for k in _keys(width, F.col("_at") % stride == 0, bands)))
    hits = rows.select("doc_id", "x", F.explode(every).alias("key")).where("key is not null")
    hits = hits.join(F.broadcast(keys), "key") if small else hits.distinct().join(keys, "key")
    found = stored(hits.select("doc_id", "x", "t").distinct(), "license-candidates")

    bucket = F.pmod("x", F.lit(ID_HASHES)).alias("bucket")
    wanted = F.broadcast(found.select(bucket).distinct())  # ID_HASHES rows at most
    again = texts.withColumn("bucket", bucket).join(wanted, "bucket", "left_semi").select("doc_id", "x", "body").alias("d")
    pairs = again.join(found.alias("f"), F.expr("d.x = f.x AND d.doc_id <=> f.doc_id")).select("d.doc_id", _words(F.col("body")).alias("words"), "t").withColumn("held", _shingles(F.col("words")))
    lists = known.select("t", "license", "grams")
    pairs = pairs.join(F.broadcast(lists) if known.limit(TEMPLATES + 1).count() <= TEMPLATES else lists, "t")
    n_found, n_template = F.size(F.array_intersect("grams", "held")).cast("long"), F.size("grams").cast("long")
    return pairs.select("doc_id", "license", n_template.alias("n_template"), n_found.alias("n_found")).where(F.col("n_found") >= contained * F.col("n_template"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every document and license notice that it holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return license_matches(docs, spark.createDataFrame([*NOTICES], "license string, text string"))


_SQL_WORDS = "list_filter(string_split_regex(lower({}), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_GRAMS = "list_distinct(CASE WHEN len(w) < 5 THEN [] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)"
SQL = f"""
WITH t(license, body) AS (VALUES {", ".join(f"('{n}', '{b}')" for n, b in NOTICES)}),
i AS (SELECT license, {_GRAMS} AS g FROM (SELECT license, {_SQL_WORDS.format("body")} AS w FROM t)),
d AS (SELECT doc_id, {_GRAMS} AS g FROM (SELECT doc_id, {_SQL_WORDS.format("text")} AS w FROM documents)),
ix AS (SELECT license, len(g) AS n_template, unnest(g) AS s FROM i), dx AS (SELECT doc_id, unnest(g) AS s FROM d)
SELECT doc_id, license, CAST(n_template AS BIGINT) AS n_template, count(*) AS n_found
FROM dx JOIN ix USING (s) GROUP BY doc_id, license, n_template HAVING count(*) >= 0.8 * n_template
"""
