"""License scans in DataFrame operations: TF-IDF cosine and containment of templates, then nearest-ancestor inheritance.

The units of a file that holds a cue word are its whole text, its comment blocks, its paragraphs (both with comment signs
taken off and wrapped lines joined) and its sentences; those with a cue word are candidates. Distinct candidates are scored
once, however many files hold them: their terms meet the templates' sparse vectors in a join, and the sums give cosines.
Where no cosine is high enough, a template counts by containment: the share of its pairs of adjacent terms that the unit
has, so that a notice is found inside a longer header. A file's license is that of the most template text matched; a bare
reservation of rights yields to any license. A file most of whose words are license text, or that is named as a licence
file, declares its license for its directory; a file without a license takes that of the nearest declaring ancestor.

Terms are weighed by document counts of all rows (`counted`) or of the templates. Only candidates, their terms, counts of
words and directories are shuffled, never other texts; a directory of very many files is one row when ancestors are looked
up. The template vectors (some thousand rows) and words in a thousandth of the rows or more are broadcast.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

GPL = "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version"
GPL_ONLY = "{0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License version {2} as published by the Free Software Foundation"
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
BSD_END = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
    "THE POSSIBILITY OF SUCH DAMAGE."
)
BSD_NAMES = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
SPDX = (
    "MIT Apache-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later "
    "AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later BSD-2-Clause BSD-3-Clause MPL-2.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC0-1.0 ISC Unlicense"
).split()

# Texts by which licenses are declared: sentences, headers, whole short licenses, titles and openings of long ones, SPDX ids.
TEMPLATES = [
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "You may not use this file except in compliance with the License; you may obtain a copy of the License at apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the 3-Clause BSD License"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms are permitted under the 2-Clause BSD License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("ISC", "Released under the ISC License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved, no part may be reproduced without permission"),
    ("proprietary", "All rights reserved"),
    ("MIT", MIT),
    ("ISC", ISC),
    ("BSD-2-Clause", BSD),
    ("BSD-2-Clause", BSD + BSD_END),
    ("BSD-3-Clause", BSD + BSD_NAMES),
    ("BSD-3-Clause", BSD + BSD_NAMES + BSD_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    *((f"{short}-{v}{'.0' if '.' not in v else ''}", form.format(what, kind, v)) for form in (GPL, GPL_ONLY) for short, kind, versions in (("GPL", "", "23"), ("LGPL", "Lesser ", ("2.1", "3")), ("AGPL", "Affero ", "3")) for v in versions for what in ("This program", "This library")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    *((re.sub("-(only|or-later)$", "", name), f"SPDX-License-Identifier: {name}") for name in SPDX),
]
SALTS = 32
YIELDING = ["proprietary"]  # said beside other licenses, too
CUE = r"(?i)licen[cs]e|permission|redistribut|public domain|all rights reserved|copyright|spdx"
NAMED = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.\-_].*)?$"
# signs that open or close a comment line
OPENS, CLOSES = r"(?m)^[ \t]*(?://+!?|/\*+|\*+/|\*+(?=[ \t\r\n]|$)|#+|--+|;+|%+|<!--+|\"\"\"|\'\'\'|(?i:rem|dnl)(?=[ \t]))[ \t]*", r"(?m)[ \t]*(?:\*+/|--+>)[ \t]*\r?$"
SENTENCE = r"\n|(?<=[.!?;])\s"
TERM = "[a-z0-9]+(?:[.\\-][a-z0-9]+)*"


def terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def weights(templates: list[tuple[str, str]]) -> tuple[list[tuple[str, int, str, float]], dict[str, float], float]:
    """(term, template, license, weight) of unit vectors, the terms' idf, and the idf of a term that no template has."""
    found = [terms(t) for _, t in templates]
    idf = {w: math.log((1 + len(found)) / (1 + sum(w in f for f in found))) + 1 for f in found for w in f}
    rows = []
    for n, (own, (name, _)) in enumerate(zip(found, templates)):
        vector = {w: own.count(w) * idf[w] for w in sorted(set(own))}
        size = math.sqrt(sum(v * v for v in vector.values()))
        rows += [(w, n, name, v / size) for w, v in vector.items()]
    return rows, idf, math.log(1 + len(found)) + 1


def unwrapped(text: Column) -> Column:
    """Without comment signs; the lines of a paragraph joined by spaces, paragraphs by line breaks."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), OPENS, ""), CLOSES, "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?<![\n \t])[ \t]*\n[ \t]*(?=[^\s])", " "), r"[ \t]*\n\s*", "\n")


def candidates(text: Column) -> Column:
    """Units with a cue word, by kind: sentences, paragraphs, comment blocks, the whole text. None for a text without one."""
    whole = F.coalesce(text, F.lit(""))
    blocks = F.transform(F.split(whole, r"\r?\n[ \t]*\r?\n"), lambda b: F.regexp_replace(unwrapped(b), "\n", " "))
    found = [F.split(whole, SENTENCE), F.split(unwrapped(whole), "\n"), blocks, F.array(F.regexp_replace(unwrapped(whole), "\n", " "))]
    cued = F.array(*(F.array_distinct(F.filter(F.transform(f, lambda s: F.trim(s)), lambda s: s.rlike(CUE))) for f in found))
    return F.when(whole.rlike(CUE), cued)


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"))


def pairs_of(found: Column) -> Column:
    n = F.greatest(F.size(found) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(found, F.lit(1), n), F.slice(found, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)))


def vocabulary(texts: DataFrame, n: int) -> DataFrame:
    """term, df (of the n rows of `_text` that have it), idf, often (in a thousandth of the rows or more)."""
    counts = texts.select(F.explode(F.array_distinct(terms_of(F.col("_text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return counts.select("term", "df", (F.log(F.lit(1 + n) / (1 + F.col("df"))) + 1).alias("idf"), (1000 * F.col("df") >= F.lit(n)).alias("often"))


def weighed(spark: SparkSession, counts: DataFrame, templates: list[tuple[str, str]], texts: DataFrame | None, n: int) -> tuple[DataFrame, DataFrame]:
    """id, term, value of the units' terms and term, template, weight of the templates' unit vectors."""
    if texts is None:
        rows, idf, unknown = weights(templates)
        vectors = spark.createDataFrame([(w, n, x) for w, n, _, x in rows], "term string, template int, weight double")
        known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))
        return counts.join(known, "term", "left").select("id", "term", (F.col("tf") * F.coalesce("idf", F.lit(unknown))).alias("value")), vectors
    known = stored(vocabulary(texts, n), "license-terms")
    often = F.broadcast(known.where("often").select("term", "idf"))
    # frequent terms never meet in a shuffle
    near = counts.join(often, "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("value"))
    far = counts.join(often, "term", "left_anti").join(known.where("NOT often").select("term", "idf"), "term", "left")
    # a term that only unwrapping makes is as rare as can be
    rarest = F.lit(math.log(1.0 + n) + 1)
    far = far.select("id", "term", (F.col("tf") * F.coalesce("idf", rarest)).alias("value"))
    own = [(w, n, terms(t).count(w)) for n, (_, t) in enumerate(templates) for w in sorted(set(terms(t)))]
    own = F.broadcast(spark.createDataFrame(own, "term string, template int, tf int"))
    idf = known.join(own.select("term").distinct(), "term", "left_semi").select("term", "idf")
    values = own.join(F.broadcast(idf), "term", "left").select("term", "template", (F.col("tf") * F.coalesce("idf", rarest)).alias("v"))
    size = values.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("size"))
    return near.unionByName(far), values.join(F.broadcast(size), "template").select("term", "template", (F.col("v") / F.col("size")).alias("weight"))


def scored(spark: SparkSession, units: DataFrame, templates: list[tuple[str, str]], least: float, held_least: float, texts: DataFrame | None, n: int) -> DataFrame:
    """id, license, score, amount (template terms matched) and whole (by cosine) of each distinct unit (id, unit) that
    has a template's cosine of `least` or its containment of `held_least`."""
    found = units.dropDuplicates(["id"]).select("id", terms_of(F.col("unit")).alias("terms"))
    counts = found.select("id", F.explode("terms").alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    values, vectors = weighed(spark, counts, templates, texts, n)
    size = values.groupBy("id").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("size"))
    dots = values.join(F.broadcast(vectors), "term").groupBy("id", "template").agg(F.sum(F.col("value") * F.col("weight")).alias("dot"))
    cosines = dots.join(size, "id").select("id", "template", F.round(F.col("dot") / F.col("size"), 9).alias("cosine")).where(F.col("cosine") >= least)
    shares = [(p, n, 1 / len(own)) for n, (_, t) in enumerate(templates) if (own := sorted({" ".join(x) for x in zip(terms(t), terms(t)[1:])})) for p in own]
    shares = F.broadcast(spark.createDataFrame(shares, "pair string, template int, share double"))
    held = found.select("id", F.explode(pairs_of(F.col("terms"))).alias("pair")).join(shares, "pair")
    held = held.groupBy("id", "template").agg(F.round(F.sum("share"), 9).alias("held")).where(F.col("held") >= held_least)
    names = spark.createDataFrame([(n, name, len(terms(t))) for n, (name, t) in enumerate(templates)], "template int, license string, terms int")
    best = cosines.join(held, ["id", "template"], "full").join(F.broadcast(names), "template").withColumn("score", F.coalesce("cosine", "held"))
    best = best.withColumn("amount", F.round(F.col("score") * F.col("terms"), 6)).withColumn("whole", F.col("cosine").isNotNull())
    order = F.struct(~F.col("license").isin(YIELDING), F.coalesce("cosine", F.lit(0.0)), F.col("amount"), -F.col("template"))
    return best.groupBy("id").agg(F.max_by(F.struct("license", "score", "amount", "whole"), order).alias("best")).select("id", "best.*")


def directory(path: Column) -> Column:
    """The part before the last slash, empty at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(
    df: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text", templates: list[tuple[str, str]] | None = None,
    least: float = 0.75, share: float = 0.5, held_least: float = 0.9, counted: bool = False,
) -> DataFrame:
    """key, path, license, score, kind ('file', 'header', 'inherited' or null), declared_in of each row of df.

    Null texts have no license of their own; null paths neither declare nor inherit; repeated rows give one row each; of
    several declarations in a directory the best score counts, then the first path, then the first license. An empty table
    gives no rows. Texts of any length are scanned in whole. Only the named columns are read. counted: terms are weighed by
    document counts of all rows.

    The texts are read once for their units with a cue word, which are written to the shared folder with the rows' names,
    and once more where terms are counted.
    """
    spark = df.sparkSession
    texts = df.select(F.col(key).alias("key"), F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("_text"))
    # equal rows have equal results: a row is known by 128 bits of its columns
    own = [F.col("key"), F.col("path"), F.col("_text"), *(F.col(c).isNull() for c in ("key", "path", "_text"))]
    row = F.struct(F.xxhash64(*own).alias("a"), F.xxhash64(F.lit("row"), *own).alias("b"))
    rows = texts.withColumn("row", row).withColumn("_found", candidates(F.col("_text")))
    words = F.when(F.col("_found").isNotNull(), F.size(terms_of(F.col("_text"))))
    rows = stored(rows.select("key", "path", "row", "_found", words.alias("words")), "license-rows")
    held = rows.where(F.col("_found").isNotNull()).select("row", "path", "words", F.posexplode("_found").alias("kind", "_units"))
    held = held.select("row", "path", "words", "kind", F.explode("_units").alias("unit")).withColumn("id", F.md5("unit"))
    n = rows.count() if counted else 0
    units = scored(spark, held.select("id", "unit"), templates or TEMPLATES, least, held_least, texts.select("_text") if counted else None, n)
    # a notice may stand in very many rows: each scored unit is met in SALTS places
    salted = units.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = held.select("row", "path", "words", "kind", "id", F.size(terms_of(F.col("unit"))).alias("size"), F.pmod(F.col("row.a"), F.lit(SALTS)).cast("int").alias("salt"))
    found = dealt.join(salted, ["id", "salt"]).drop("salt")
    best = F.struct(~F.col("license").isin(YIELDING), F.col("amount"), F.col("score"), F.col("license"))
    # a unit matched by cosine is license text as a whole, another one by its template's terms
    covers = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.when(F.col("whole"), F.col("size")).otherwise(F.least("size", "amount")))), F.lit(0)) for k in range(4)]
    own = found.dropDuplicates(["row", "kind", "id"]).groupBy("row").agg(
        F.first("path").alias("path"), F.max_by("score", best).alias("score"), F.max_by("license", best).alias("license"),
        (F.greatest(*covers) >= share * F.first("words")).alias("mostly"),
    )
    named = F.coalesce(F.element_at(F.split("path", "/"), -1).rlike(NAMED), F.lit(False))
    own = own.withColumn("file", F.col("mostly") | named)
    first = F.struct(-F.col("score"), F.col("path"), F.col("license"))
    declared = own.where(F.col("file") & F.col("path").isNotNull()).groupBy(directory(F.col("path")).alias("declared_in")).agg(
        F.min_by("license", first).alias("given"), F.max("score").alias("given_score")
    )
    parts = F.split("directory", "/")
    depth = F.when(F.col("directory") == "", 0).otherwise(F.size(parts))
    above = F.transform(F.sequence(F.lit(0), depth), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("declared_in")))
    homes = rows.where(F.col("path").isNotNull()).select(directory(F.col("path")).alias("directory")).distinct()
    nearest = homes.select("directory", F.explode(above).alias("up")).select("directory", "up.*").join(declared, "declared_in").groupBy("directory").agg(
        F.max_by(F.struct("declared_in", "given", "given_score"), "depth").alias("near")
    )
    placed = rows.select("key", "path", "row", directory(F.col("path")).alias("directory")).join(own.select("row", "license", "score", "file"), "row", "left")
    placed = placed.join(nearest, "directory", "left")
    kind = F.when(F.col("license").isNull(), F.when(F.col("near").isNotNull(), "inherited")).otherwise(F.when(F.col("file"), "file").otherwise("header"))
    return placed.select(
        "key", "path", F.coalesce("license", "near.given").alias("license"), F.coalesce("score", "near.given_score").alias("score"),
        kind.alias("kind"), F.when(kind == "inherited", F.col("near.declared_in")).alias("declared_in"),
    )
