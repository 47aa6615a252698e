"""License scans: MinHash bands over text windows retrieve templates, exact
shingle containment verifies them.

1. The five-word shingles of all texts meet the distinct shingles of all templates
   in a broadcast table. Only these hits go on; a text without one has no license.
2. Overlapping windows of ``WINDOW`` places lie over a text, one every ``STRIDE``;
   a template is cut into disjoint pieces of ``PIECE`` shingles. Any piece that is
   whole in a text lies in a window whole, so window and piece have a Jaccard
   similarity of ``PIECE / WINDOW`` or more, and one of the ``BANDS`` single-row
   MinHash bands agrees with the probability that ``bands_for`` was asked for. A
   text that lacks a fifth of the shingles or less keeps some piece whole, as there
   are more pieces than missing shingles. Templates too short for that have each of
   their shingles for a key.
3. Retrieved templates are held exactly against the hits, which are all of their
   shingles that the text has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.native import let, run_keys
from spanloom.llm.stages import written

SHINGLE = 5

#: Parts of the texts of short licenses.
AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS {holders}BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
    "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
    "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software. " + AS_IS.format(holders="OR COPYRIGHT HOLDERS ")
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
    "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source "
    "code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
    "written permission."
)
BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
    "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or "
    "authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to "
    "the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
    "under copyright law. " + AS_IS.format(holders="")
)

#: License names with notices, sentences and whole short licenses.
TEMPLATES = (
    ("MIT", MIT),
    ("ISC", ISC),
    ("BSD-2-Clause", f"{BSD_TWO} {BSD_END}"),
    ("BSD-3-Clause", f"{BSD_TWO} {BSD_THIRD} {BSD_END}"),
    ("Unlicense", UNLICENSE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)


def bands_for(similarity: float, target: float) -> int:
    """Fewest single-row bands that collide with probability ``target`` or more."""
    return 1 if similarity >= 1 else math.ceil(math.log(1 - target) / math.log(1 - similarity))


#: Shingles of a piece, and of the step between text windows. With pieces of three a
#: template of ``n`` shingles has ``n // 3`` of them, more than the ``n // 5`` that may
#: lack, from ``LEAST`` shingles on.
PIECE, STRIDE, LEAST = 3, 2, 6
WINDOW = PIECE + STRIDE - 1
BANDS = bands_for(PIECE / WINDOW, 1 - 1e-6)
#: Templates whose shingles may be broadcast: 12 bytes each.
MOST_SHINGLES = 4_000_000


def read_templates(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(license, text) of the files of a folder, named by the files without their
    endings: a bounded parameter, such as a folder of full license texts."""
    rows = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.txt)?$", 1).alias("name"), "value")
    return sorted((r["name"], r["value"]) for r in rows.collect())


def scan_words(text: Column) -> Column:
    """Lower-case words of letters, digits and hyphens; non-ASCII characters count
    as letters, everything else separates."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2C\x2E\x2F\x3A-\x60\x7B-\x7F]+"), "")


def shingle_hashes(tokens: Column) -> Column:
    return run_keys(F.transform(tokens, lambda w: F.xxhash64(w)), SHINGLE)


def band_keys(hashes: Column) -> Column:
    """The least value of a set of shingles in the order of each band, marked with
    the band."""
    return F.array(*[F.xxhash64(F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))), F.lit(band)) for band in range(BANDS)])


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, license, hashes) with the distinct shingles in order."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template long, license string, template_text string").coalesce(1)
    return rows.select("template", "license", let(scan_words(F.col("template_text")), lambda w: F.array_distinct(shingle_hashes(w))).alias("hashes"))


def template_keys(table: DataFrame) -> DataFrame:
    """(template, key) of every band of every piece; of short templates (template,
    shingle)."""
    starts = F.sequence(F.lit(1), F.size("hashes") - PIECE + 1, F.lit(PIECE))
    pieces = F.transform(starts, lambda at: band_keys(F.slice("hashes", at, F.lit(PIECE))))
    keys = F.when(F.size("hashes") >= LEAST, F.flatten(pieces)).otherwise(F.col("hashes"))
    return table.filter(F.size("hashes") > 0).select("template", F.explode(F.array_distinct(keys)).alias("key")).distinct()


def text_keys(hits: DataFrame) -> DataFrame:
    """(row_key, key) of the windows of a text, and of its single hits."""
    windows = F.sequence(F.greatest(F.ceil((F.col("pos") - WINDOW + 1) / STRIDE), F.lit(0)).cast("int"), F.floor(F.col("pos") / STRIDE).cast("int"))
    least = [F.min(F.xxhash64("shingle", F.lit(band))).alias(f"band_{band}") for band in range(BANDS)]
    met = hits.select("row_key", "shingle", F.explode(windows).alias("window")).groupBy("row_key", "window").agg(*least)
    keys = met.select("row_key", F.explode(F.array(*[F.xxhash64(f"band_{band}", F.lit(band)) for band in range(BANDS)])).alias("key"))
    return keys.unionByName(hits.select("row_key", F.col("shingle").alias("key"))).distinct()


def rival_templates(table: DataFrame, min_containment: float) -> DataFrame:
    """(template, rivals): templates that contain this one nearly whole."""
    each = table.select("template", F.size("hashes").alias("n"), F.explode("hashes").alias("shingle"))
    other = each.select(F.col("template").alias("rival"), "shingle")
    shared = each.join(other, "shingle").filter("rival <> template").groupBy("template", "rival", "n").count()
    return shared.filter(F.col("count") >= min_containment * F.col("n")).groupBy("template").agg(F.collect_set("rival").alias("rivals"))


def scan_licenses(docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_containment: float = 0.8, templates=TEMPLATES) -> DataFrame:
    """One row per document and license found: ``doc_id, license, n_templates,
    containment`` (the best share of a template's distinct shingles in the text).

    Where nearly equal templates match one text (versions of a license, a sentence
    and its license), those with a smaller share than a rival, or an equal one of
    a shorter template, are left out. ``min_containment`` is 0.8 or more, else a
    text may lack a shingle of every piece. Null, blank and short texts have no
    shingles and give no row; rows that repeat a ``doc_id`` count as one document,
    those with a null id too; an empty table gives no row; further columns are
    ignored. ``templates`` may be thousands of whole license texts, as
    ``read_templates`` gives them; more than ``MOST_SHINGLES`` distinct shingles
    are joined without a broadcast.
    """
    if min_containment < 0.8:
        raise ValueError("min_containment must be 0.8 or more")
    known = written(template_table(docs.sparkSession, templates))
    each = known.select("template", F.explode("hashes").alias("shingle"))
    distinct = written(each.select("shingle").distinct())
    wanted = F.broadcast(distinct) if distinct.count() <= MOST_SHINGLES else distinct
    content = F.col(f"`{text}`")
    # In two steps: what stands beside a generator is worked out for each of its rows.
    hashed = docs.select(F.col(f"`{id}`").alias("doc_id"), F.xxhash64(F.col(f"`{id}`"), content).alias("row_key"), shingle_hashes(scan_words(content)).alias("hashes"))
    hashed = hashed.select("doc_id", "row_key", F.posexplode("hashes").alias("pos", "shingle"))
    # Hits are the part of the corpus that is license text; all else works on them.
    hits = written(hashed.join(wanted, "shingle", "left_semi"))
    retrieved = text_keys(hits).join(template_keys(known), "key").select("row_key", "template").distinct()
    found = hits.select("doc_id", "row_key", "shingle").distinct().join(each, "shingle").join(retrieved, ["row_key", "template"])
    counted = found.groupBy("doc_id", "row_key", "template").agg(F.count(F.lit(1)).alias("n_met"))
    sizes = known.select("template", "license", F.size("hashes").alias("n")).join(rival_templates(known, min_containment), "template", "left").withColumn("rivals", F.coalesce("rivals", F.array().cast("array<bigint>")))
    share = F.round(F.col("n_met") / F.col("n"), 6)
    verified = counted.join(sizes, "template").withColumn("containment", share).filter(F.col("containment") >= min_containment)
    # At most one entry for a template of the fixed table.
    matched = verified.groupBy("doc_id").agg(F.collect_set(F.struct("template", "license", "rivals", "n", "containment")).alias("found"))
    better = lambda x, y: (y["containment"] > x["containment"]) | (y["containment"] == x["containment"]) & (y["n"] > x["n"])
    best = F.filter("found", lambda x: ~F.exists("found", lambda y: F.array_contains(x["rivals"], y["template"]) & better(x, y)))
    kept = matched.select("doc_id", F.explode(best).alias("x")).select("doc_id", "x.license", "x.containment")
    return kept.groupBy("doc_id", "license").agg(F.count(F.lit(1)).alias("n_templates"), F.max("containment").alias("containment"))
