"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

A text becomes words (ASCII letters and digits, lower case) and 5-word shingles. Templates are grouped by their number n
of shingles. For n below 5, containment of 0.8 means every shingle: windows of n shingles start at every word, and one
band suffices, as the sets are equal. For longer templates windows of n + step shingles start every step = n / 8: an
occurrence lies whole in some window, and its Jaccard similarity with the template is at least ``similarity(n)``; the
number of one-row bands makes a collision at that similarity at least ``COLLISION`` likely. A window that meets a template
in a band is verified: the share of the template's distinct shingles, compared as text, that the window has.

A band collision needs the template's least shingle inside the window. So texts and windows without any template's
signature shingle are passed over before bands are computed, without loss.

Only DataFrame functions. A text stays on its row up to the matches, which are few; templates and their bands are joined
by broadcast up to ``BROADCAST_ROWS`` band rows and by a shuffle beyond.

Cases: null text or one of fewer than five words: no match; templates of fewer than five words or a null text are
ignored; matches of repeated rows and of rows with one doc_id join in one row per license; a null doc_id is a group; empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
COLLISION = 0.9999
BROADCAST_ROWS = 100_000
# Signature shingles up to which texts are tested against a literal set first.
LITERAL_SHINGLES = 5_000

# License notices (license id, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: Redistributions of source code must retain the above "
                     "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
                     "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def step_of(n: int) -> int:
    """Shingles between the starts of windows for templates of n shingles."""
    return 1 if n < SHINGLE else max(1, n // 8)


def window_of(n: int) -> int:
    """Shingles in a window for templates of n shingles."""
    return n if n < SHINGLE else n + step_of(n)


def similarity(n: int) -> float:
    """Least Jaccard similarity of a template and the window that holds an occurrence of the least containment."""
    if n < SHINGLE:
        return 1.0
    return CONTAINMENT * n / (window_of(n) + (1 - CONTAINMENT) * n)


def bands_of(n: int) -> int:
    s = similarity(n)
    return 1 if s >= 1 else math.ceil(math.log(1 - COLLISION) / math.log(1 - s))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def _each(array: Column, fn, width: int = SHINGLE) -> Column:
    """``fn`` of the words of each run of ``width``; ``array`` is evaluated once."""
    def runs(ws: Column) -> Column:
        at = F.when(F.size(ws) >= width, F.sequence(F.lit(0), F.size(ws) - width)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: fn(*[F.get(ws, i + j) for j in range(width)]))

    return F.transform(F.array(array), runs)[0]


def shingle_hashes(ws: Column) -> Column:
    return _each(ws, F.xxhash64)


def shingle_texts(ws: Column) -> Column:
    return F.array_distinct(_each(ws, lambda *w: F.concat_ws(" ", *w)))


def minhash(hashes: Column, band: int) -> Column:
    """The shingle hash that comes first in the band's order."""
    return F.array_min(F.transform(hashes, lambda h: F.struct(F.xxhash64(h, F.lit(band)).alias("o"), h.alias("h"))))["h"]


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """The templates as literals."""
    rows = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in templates])
    return spark.range(1).select(F.inline(rows))


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """(doc_id, license_id, containment): for each document the licenses with a verified window, and the best share."""
    spark = docs.sparkSession
    known = (template_table(spark) if templates is None else templates).select("license_id", words(F.col("text")).alias("ws"))
    known = known.where(F.size("ws") >= SHINGLE).select("license_id", "ws", shingle_hashes(F.col("ws")).alias("hs"))
    known = known.select("license_id", F.size("hs").alias("n"), F.array_distinct("hs").alias("hs"),
                         shingle_texts(F.col("ws")).alias("texts"))
    lengths = sorted(r.n for r in known.select("n").distinct().collect())  # different lengths of templates
    if not lengths:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("").alias("license_id"),
                           F.lit(0.0).alias("containment")).where(F.lit(False))
    top = max(bands_of(n) for n in lengths)
    keys = F.array(*[minhash(F.col("hs"), b) for b in range(top)])
    limit = F.lit(1)
    for n in lengths:
        limit = F.when(F.col("n") == n, bands_of(n)).otherwise(limit)
    signature = known.select("license_id", "n", "texts", F.posexplode(F.slice(keys, F.lit(1), limit)).alias("band", "key"))
    signature_rows = signature.count()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("ws"))
    rows = rows.select("doc_id", "ws", shingle_hashes(F.col("ws")).alias("hs"))
    least = {n: None for n in lengths}
    if signature_rows <= LITERAL_SHINGLES:
        keys_of = {r.n: r.keys for r in signature.groupBy("n").agg(F.collect_set("key").alias("keys")).collect()}
        least = {n: F.array(*[F.lit(k) for k in sorted(keys_of[n])]) for n in lengths}
        rows = rows.where(F.arrays_overlap("hs", F.array(*[F.lit(k) for k in sorted({k for ks in keys_of.values() for k in ks})])))

    def windows(n: int) -> Column:
        starts = F.when(F.size("hs") > 0, F.sequence(F.lit(0), F.size("hs") - 1, F.lit(step_of(n)))) \
            .otherwise(F.array().cast("array<int>"))
        cut = F.transform(starts, lambda i: F.struct(
            F.lit(n).alias("n"), F.slice("hs", i + 1, F.lit(window_of(n))).alias("hs"),
            F.slice("ws", i + 1, F.lit(window_of(n) + SHINGLE - 1)).alias("ws")))
        return cut if least[n] is None else F.filter(cut, lambda w: F.arrays_overlap(w["hs"], least[n]))

    cut = rows.select("doc_id", F.explode(F.concat(*[windows(n) for n in lengths])).alias("w"))
    cut = cut.select("doc_id", F.col("w.n").alias("n"), F.col("w.hs").alias("hs"), F.col("w.ws").alias("ws"))
    banded = cut.select("doc_id", "n", "ws", F.posexplode(F.slice(keys, F.lit(1), limit)).alias("band", "key"))
    met = banded.join(F.broadcast(signature) if signature_rows <= BROADCAST_ROWS else signature, ["n", "band", "key"])
    share = F.size(F.array_intersect("texts", shingle_texts(F.col("ws")))) / F.size("texts")
    verified = met.select("doc_id", "license_id", share.alias("share")).where(F.col("share") >= CONTAINMENT)
    return verified.groupBy("doc_id", "license_id").agg(F.round(F.max("share"), 6).alias("containment"))


def oracle_sql(templates=TEMPLATES) -> str:
    """The exact answer, without bands, in DuckDB SQL: windows around the shingles that occur in a template."""
    values = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in templates)
    return f"""
WITH given(license_id, text) AS (VALUES {values}),
t0 AS (SELECT row_number() OVER () AS tid, license_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS ws FROM given),
t1 AS (SELECT tid, license_id, len(ws) - 4 AS n, unnest(list_transform(range(1, len(ws) - 3),
  lambda i: array_to_string(ws[i:i + 4], ' '))) AS sh FROM t0 WHERE len(ws) >= 5),
t2 AS (SELECT tid, license_id, n, sh, CASE WHEN n < 5 THEN 1 ELSE greatest(1, n // 8) END AS step FROM t1 GROUP BY ALL),
t AS (SELECT *, CASE WHEN n < 5 THEN n ELSE n + step END AS width, count(*) OVER (PARTITION BY tid) AS total FROM t2),
d0 AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS ws FROM documents),
d AS (SELECT rid, doc_id, unnest(range(0, len(ws) - 4)) AS pos, unnest(list_transform(range(1, len(ws) - 3),
  lambda i: array_to_string(ws[i:i + 4], ' '))) AS sh FROM d0 WHERE len(ws) >= 5),
hit AS (SELECT rid, doc_id, pos, d.sh, tid, license_id, step, width, total FROM d JOIN t ON d.sh = t.sh),
spot AS (SELECT *, unnest(range(greatest(0, (pos - width + step) // step)::BIGINT, (pos // step + 1)::BIGINT)) * step AS start FROM hit),
share AS (SELECT doc_id, license_id, count(DISTINCT sh) / total AS share FROM spot WHERE start <= pos AND pos < start + width
  GROUP BY rid, doc_id, tid, license_id, total, start)
SELECT doc_id, license_id, round(max(share), 6) AS containment FROM share WHERE share >= {CONTAINMENT} GROUP BY ALL
"""
