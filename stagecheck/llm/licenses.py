"""Operator 6: license texts by MinHash over overlapping windows.

Templates are grouped by size. For a group of templates of 2**k to 2**(k+1) - 1 shingles (five words
each), a document's shingles are cut into windows of 2.5 * 2**k, one every 2**(k-1), so that each
run of 2 * 2**k stands whole in one window. A template of which a share of 0.8 stands there has a
resemblance of at least 0.3 to it, and with ``BANDS`` bands of one MinHash each it is retrieved with
probability 1 - 0.7**32, above 0.99998. What the bands retrieve is verified by exact containment: the
share of the template's shingles that the window holds. Licenses share wording, so of finds of different
licenses that overlap in the text the one with the greater containment stands, at equal ones that of the longer template.

Only DataFrame operations. Windows without any shingle of a template can't collide in any band, so
only the others are hashed; that keeps the signatures to a few rows while every shingle of every
text is looked at. The templates are a constant list and are broadcast.

Defined cases: null counts as empty; texts of fewer than five words hold no license; a license is
reported once for a text, at its best and first window; repeated rows are judged alike; no
templates, or no rows, give no finds; other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stagecheck.llm.common import settle

SHINGLE = 5
BANDS = 32
CONTAINMENT = 0.8
#: License texts and the notices that go with them, as they are printed.
TEMPLATES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
                   "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
                     "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
                     "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
                     "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                     "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
                     "PURPOSE ARE DISCLAIMED."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
                     "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
                     "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
                     "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
                     "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
                     "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
            'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
            "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
            "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR "
            "IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
             "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
             "commercial applications, and to alter it and redistribute it freely"),
)


def _words(text: Column) -> Column:
    """Runs of letters, digits and underscores in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+"), "")


def _hashed(df: DataFrame, words: str, name: str) -> DataFrame:
    """Adds the hashes of the runs of five words, in order."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(SHINGLE))
    return df.withColumn(name, F.expr(
        f"CASE WHEN size({words}) < {SHINGLE} THEN CAST(array() AS array<bigint>) "
        f"ELSE transform(sequence(0, size({words}) - {SHINGLE}), i -> xxhash64({parts})) END"))


def _bands(shingles_: str) -> Column:
    return F.expr(f"transform(sequence(1, {BANDS}), j -> xxhash64(j, array_min(transform({shingles_}, h -> xxhash64(h, j)))))")


def _windows(level: int) -> Column:
    """The windows of a level that reach over a hit; each begins at a multiple of the step."""
    step = max(1, (1 << level) // 2)
    size = 2 * (1 << level) + step
    over = F.transform("_hits", lambda p: F.sequence(
        F.greatest(F.lit(0), F.ceil((p - size + 1) / step)).cast("int"), F.floor(p / step).cast("int")))
    return F.transform(F.array_distinct(F.flatten(over)), lambda w: F.struct(
        F.lit(level).alias("level"), (w * step).alias("start"), F.lit(size).alias("size")))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """template, license, shingles (distinct) and level: the power of two below their number."""
    rows = spark.createDataFrame([(n, *t) for n, t in enumerate(templates)], "template int, license string, text string")
    rows = _hashed(rows.withColumn("words", _words(F.col("text"))), "words", "shingles")
    rows = rows.withColumn("shingles", F.array_distinct("shingles")).where(F.size("shingles") > 0)
    return rows.select("template", "license", "shingles", F.floor(F.log2(F.size("shingles"))).cast("int").alias("level"))


def find_licenses(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
                  templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """``keep``, licenses and matches (license, containment, first_word, last_word) for every row of ``df``."""
    spark = df.sparkSession
    # A few rows that come from a constant; their hashes go into the plan as literals.
    known = [tuple(r) for r in template_table(spark, templates).collect()]
    wanted = sorted({h for _, _, hashes, _ in known for h in hashes})
    rows = df.select(*keep, F.monotonically_increasing_id().alias("_row"), _words(F.col(text)).alias("_words"))
    rows = _hashed(rows, "_words", "_shingles").drop("_words")
    hits = F.expr("filter(transform(_shingles, (h, i) -> IF(h IN ({}), i, -1)), i -> i >= 0)".format(", ".join(f"{h}L" for h in wanted) or "NULL"))
    rows = rows.withColumn("_hits", hits)
    rows = settle(rows.withColumn("_shingles", F.when(F.size("_hits") > 0, F.col("_shingles"))), "license-rows")
    if not known:
        return rows.select(*keep, F.array().cast("array<string>").alias("licenses"),
                           F.array().cast("array<struct<license:string,containment:double,first_word:int,last_word:int>>").alias("matches"))
    table = settle(spark.createDataFrame(known, "template int, license string, shingles array<bigint>, level int"), "license-templates")
    levels = sorted({level for *_, level in known})
    cut = [_windows(level) for level in levels]
    windows = rows.where(F.size("_hits") > 0).select("_row", "_shingles", F.explode(F.concat(*cut)).alias("w")).select(
        "_row", "w.level", "w.start", F.slice("_shingles", F.col("w.start") + 1, F.col("w.size")).alias("window"))
    bands = F.broadcast(table.select("template", "level", F.explode(_bands("shingles")).alias("band")).distinct())
    met = windows.withColumn("band", F.explode(_bands("window"))).join(bands, ["level", "band"])
    met = met.groupBy("_row", "level", "start", "template").agg(F.first("window").alias("window")).join(
        F.broadcast(table.select("template", "license", "shingles")), "template")
    share = F.size(F.array_intersect("shingles", "window")) / F.size("shingles")
    places = F.expr("filter(transform(window, (h, i) -> IF(array_contains(shingles, h), i, -1)), i -> i >= 0)")
    found = met.withColumn("containment", share).where(F.col("containment") >= containment).withColumn("_at", places)
    found = found.select("_row", "license", "containment", F.size("shingles").alias("shingles"), (F.col("start") + F.array_min("_at")).cast("int").alias("first_word"),
                         (F.col("start") + F.array_max("_at") + SHINGLE - 1).cast("int").alias("last_word"))
    best = found.groupBy("_row", "license").agg(F.min(F.struct(
        (-F.col("containment")).alias("less"), (-F.col("shingles")).alias("fewer"), "first_word", "last_word")).alias("m"))
    best = best.groupBy("_row").agg(F.collect_list(F.struct("m.*", "license")).alias("_m"))
    # Finds are ordered by containment, then size: what stands ahead and overlaps wins.
    alone = F.filter("_m", lambda m: ~F.exists("_m", lambda n: (n["license"] != m["license"]) & (n["first_word"] <= m["last_word"]) & (
        m["first_word"] <= n["last_word"]) & (F.struct(n["less"], n["fewer"], n["license"]) < F.struct(m["less"], m["fewer"], m["license"]))))
    best = best.select("_row", F.sort_array(F.transform(alone, lambda m: F.struct(
        m["license"].alias("license"), (-m["less"]).alias("containment"), m["first_word"].alias("first_word"),
        m["last_word"].alias("last_word")))).alias("matches"))
    out = rows.drop("_shingles", "_hits").join(best, "_row", "left")
    matches = F.coalesce("matches", F.array().cast("array<struct<license:string,containment:double,first_word:int,last_word:int>>"))
    return out.select(*keep, F.transform(matches, lambda m: m["license"]).alias("licenses"), matches.alias("matches"))
