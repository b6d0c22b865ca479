"""License scans, in DataFrame operations only: sparse TF-IDF cosine to templates, then inheritance by path.

Templates are whole paragraphs of usual headers and license files, short notices, and titles with license identifiers.
Texts are cut into paragraphs, and these into sentences, wrapped or not, and pieces of single lines: all are units. A
unit's vector has the words of the templates as dimensions, weighted by the inverse document frequency over all documents;
any other word weighs as a word that no document has. Titles are short, so a unit must hold all words of one. Units that lack all of the templates' rarest words can't reach ``COSINE`` and are skipped:
the rarest words are those without which every template's vector is shorter than the threshold.

A document whose license units hold at least half of its words, or whose file is named as one, licenses
its directory. A document without license of its own takes that of its nearest ancestor directory.

Defined cases: a null text or path counts as empty; ties go to the first template by name; several
license files in a directory: the one with the smallest path; repeated rows are each reported; other
columns are ignored.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import table
from demandspark.sources import scratch

COSINE = 0.75

# Usual notices by license.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
)
# Paragraphs of usual headers and license files.
PARAGRAPHS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Titles of licenses and license files; license identifiers.
_NAMES = (
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
_IDENTIFIERS = (
    "0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT",
    "MIT-0", "MPL-2.0", "Unlicense", "Zlib",
)
TITLES = (
    *_NAMES,
    *((name, f"SPDX-License-Identifier: {name}") for name in _IDENTIFIERS),
    *((name, f"SPDX-License-Identifier: {name}-{end}") for name in _IDENTIFIERS if "GPL" in name for end in ("only", "or-later")),
)
_WORDS = "filter(split(lower({}), '[^a-z0-9]+'), x -> x <> '')"
_ENDS = r"(?<=[.!?;])\\s+"
_PARAGRAPHS = r"split(text, '\\n(?:[^A-Za-z0-9\\n]*+\\n)+')"
#: Per paragraph: pieces of lines (kind 0), sentences over several lines (1), the paragraph if it has several pieces (2).
_UNITS = (
    f"flatten(transform({_PARAGRAPHS}, (p, i) -> concat("
    f"transform(split(p, '\\\\n|{_ENDS}'), x -> struct(i as para, 0 as kind, x as text)), "
    f"transform(filter(split(p, '{_ENDS}'), x -> instr(x, '\\n') > 0), x -> struct(i as para, 1 as kind, x as text)), "
    f"if(p rlike '\\\\n|{_ENDS}', array(struct(i as para, 2 as kind, p as text)), array()))))"
)


def template_words(spark: SparkSession, templates, titles) -> DataFrame:
    """(template, license, need, word, times): a fixed list of some hundred rows; ``need``: words a unit must hold."""
    listed = [(k, *t, k >= len(templates)) for k, t in enumerate((*templates, *titles))]
    rows = spark.createDataFrame(listed, "template int, license string, notice string, title boolean")
    rows = rows.withColumn("words", F.expr(_WORDS.format("notice")))
    rows = rows.withColumn("need", F.expr("if(title, size(array_distinct(words)), 0)"))
    words = rows.select("template", "license", "need", F.explode("words").alias("word"))
    return words.groupBy("template", "license", "need", "word").agg(F.count("*").alias("times"))


def scan(
    docs: DataFrame, templates=(*TEMPLATES, *PARAGRAPHS), titles=TITLES, cosine: float = COSINE
) -> DataFrame:
    """(row, path, doc_id, license, score, is_file) of every document of (doc_id, path, text)."""
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("path", F.lit("")).alias("path"), F.coalesce("text", F.lit("")).alias("text")
    )
    words = template_words(spark, templates, titles)
    listed = sorted(words.collect())  # the fixed list
    vocabulary = sorted({r["word"] for r in listed})
    known = F.array(*map(F.lit, vocabulary))
    in_documents = docs.select(F.explode(F.array_intersect(F.expr(_WORDS.format("text")), known)).alias("word"))
    counts = {r["word"]: r["n"] for r in in_documents.groupBy("word").agg(F.count("*").alias("n")).collect()}  # the vocabulary
    total = docs.count()
    idf = {w: log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}
    other = log(1 + total) + 1
    vectors: dict[int, dict[str, float]] = {}
    for r in listed:
        vectors.setdefault(r["template"], {})[r["word"]] = r["times"] * idf[r["word"]]
    norms = {k: sum(x * x for x in v.values()) ** 0.5 for k, v in vectors.items()}
    named = {r["template"]: (r["license"], r["need"]) for r in listed}
    # The fewest rare words such that what is left of every template is shorter than the threshold; one for a title.
    rare: set[str] = set()
    for k, v in vectors.items():
        for w in sorted(v, key=lambda w: (-idf[w], w)):
            if named[k][1] and rare & set(v):
                break
            if sum(x * x for y, x in v.items() if y not in rare) ** 0.5 < cosine * norms[k] * 0.999:
                break
            rare.add(w)
    weights = spark.createDataFrame(
        [(k, *named[k], w, x / norms[k]) for k, v in vectors.items() for w, x in v.items()],
        "template int, license string, need int, word string, weight double",
    )
    idfs = F.create_map(*(F.lit(x) for w in vocabulary for x in (w, idf[w])))
    hint = F.lower("text").rlike("(?<![a-z0-9])(" + "|".join(sorted(rare)) + ")(?![a-z0-9])") if rare else F.lit(False)

    rows = docs.withColumn("size", F.expr(f"size({_WORDS.format('text')})")).withColumn("hint", hint)
    rows = rows.withColumn("units", F.expr(f"if(hint, {_UNITS}, cast(array() as array<struct<para:int,kind:int,text:string>>))"))
    anchors = ", ".join(f"'{w}'" for w in sorted(rare)) or "''"
    kept = f"filter(transform(units, u -> struct(u.para, u.kind, {_WORDS.format('u.text')} as words)), u -> arrays_overlap(u.words, array({anchors})))"
    rows = rows.select("doc_id", "path", "size", F.expr(kept).alias("units")).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.materialize(rows, "license-units")

    units = rows.where("size(units) > 0").select("row", F.posexplode("units").alias("unit", "u")).select("row", "unit", "u.*")
    unit = ["row", "unit", "para", "kind", "length"]
    terms = units.select("row", "unit", "para", "kind", F.size("words").alias("length"), F.explode("words").alias("word"))
    terms = terms.groupBy(*unit, "word").agg(F.count("*").alias("times"))
    terms = terms.withColumn("x", F.col("times") * F.coalesce(F.try_element_at(idfs, F.col("word")), F.lit(other)))
    lengths = terms.groupBy("row", "unit").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = terms.join(F.broadcast(weights), "word").groupBy(*unit, "template", "license", "need")
    dots = dots.agg(F.sum(F.expr("x * weight")).alias("dot"), F.count("*").alias("held")).where("held >= need")
    near = dots.join(lengths, ["row", "unit"]).withColumn("score", F.col("dot") / F.col("norm")).where(F.col("score") >= cosine)
    best = near.groupBy(*unit).agg(F.max(F.struct("score", F.expr("-template").alias("t"), "license")).alias("b"))
    best = best.withColumn("b", F.struct("b.score", F.expr("-unit").alias("u"), "b.license"))
    # Units of one kind don't overlap; of a paragraph's kinds the one that covers most words counts.
    covered = best.groupBy("row", "para", "kind").agg(F.max("b").alias("b"), F.sum("length").alias("covered"))
    covered = covered.groupBy("row", "para").agg(F.max("b").alias("b"), F.max("covered").alias("covered"))
    per = covered.groupBy("row").agg(F.max("b").alias("b"), F.sum("covered").alias("covered"))
    found = rows.select("row", "doc_id", "path", "size").join(per, "row", "left")
    is_file = F.expr("covered * 2 >= size or (covered > 0 and lower(element_at(split(path, '/'), -1)) rlike '^(licen[cs]e|copying)([.].*)?$')")
    return found.select(
        "row", "doc_id", "path", F.col("b.license").alias("license"), F.col("b.score").alias("score"), F.coalesce(is_file, F.lit(False)).alias("is_file")
    )


def inherited(found: DataFrame) -> DataFrame:
    """(doc_id, license, score, origin, source_path): own licenses, else those of the nearest ancestor directory."""
    found = scratch.materialize(found, "licenses")
    folder = F.expr("array_join(slice(split(path, '/'), 1, size(split(path, '/')) - 1), '/')")
    files = found.where("is_file").groupBy(folder.alias("folder")).agg(F.min(F.struct("path", "license", "score")).alias("f"))
    bare = found.where("license is null").select("row", F.split("path", "/").alias("p"))
    above = bare.select("row", F.explode(F.expr("transform(sequence(0, size(p) - 1), k -> struct(k as depth, array_join(slice(p, 1, k), '/') as folder))")).alias("x"))
    near = above.select("row", "x.*").join(files, "folder").groupBy("row").agg(F.max(F.struct("depth", "f")).alias("n"))
    return found.join(near, "row", "left").select(
        "doc_id",
        F.coalesce("license", "n.f.license").alias("license"),
        F.coalesce("score", "n.f.score").alias("score"),
        F.expr("case when license is not null and is_file then 'file' when license is not null then 'header' when n is not null then 'inherited' else 'none' end").alias("origin"),
        F.expr("case when license is not null then path else n.f.path end").alias("source_path"),
    )


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License of every document; directories are the source and blocks of a thousand ids in it."""
    docs = table(spark, folder, "documents", "doc_id", "source", "text")
    path = F.concat_ws("/", "source", F.expr("doc_id div 1000"), F.col("doc_id"))
    return inherited(scan(docs.withColumn("path", path))).withColumn("score", F.round("score", 6))
