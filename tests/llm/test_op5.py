"""Licenses against plain TF-IDF over all units, and inheritance by path."""

import math
import re
from collections import Counter

from demandspark.llm import op5_licenses as op
from demandspark.llm.registry import QUERIES


def words(text):
    return re.findall("[a-z0-9]+", text.lower())


def units(text):
    """Pieces of lines, wrapped sentences, paragraphs."""
    for p in re.split(r"\n(?:[^A-Za-z0-9\n]*\n)+", text):
        pieces = re.split(r"\n|(?<=[.!?;])\s+", p)
        yield from pieces
        yield from (x for x in re.split(r"(?<=[.!?;])\s+", p) if "\n" in x)
        if len(pieces) > 1:
            yield p


def brute(docs):
    listed = [(name, t, False) for name, t in (*op.TEMPLATES, *op.PARAGRAPHS)] + [(name, t, True) for name, t in op.TITLES]
    vocabulary = {w for _, t, _ in listed for w in words(t)}
    df = Counter(w for t in docs.values() for w in set(words(t or "")) & vocabulary)
    weigh = lambda w: math.log((1 + len(docs)) / (1 + (df[w] if w in vocabulary else 0))) + 1
    vector = lambda t: {w: n * weigh(w) for w, n in Counter(words(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    notices = [(name, vector(t), norm(vector(t)), title) for name, t, title in listed]
    out = {}
    for i, text in docs.items():
        best = (0.0, None)
        for unit in set(units(text or "")):
            v = vector(unit)
            size = norm(v)
            for name, t, length, title in notices:
                if v and not (title and set(t) - set(v)):
                    score = sum(x * t.get(w, 0) for w, x in v.items()) / size / length
                    if score >= op.COSINE and score > best[0] + 1e-12:
                        best = (score, name)
        out[i] = (best[1], round(best[0], 6) if best[1] else None)
    return out


def test_query(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = brute(docs)
    rows = QUERIES["op5_licenses"][0](spark, folder).collect()
    assert len(rows) == len(docs)
    own = {r.doc_id: (r.license, r.score) for r in rows if r.origin in ("header", "file")}
    assert own == {i: x for i, x in want.items() if x[0]} and own


def test_inheritance_and_odd_rows(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/x.py", "code"), (3, "a/b/c/COPYING", apache + " more words that are not a license at all, many of them here"),
        (4, "a/b/c/d/y.py", "code"), (5, "z/y.py", "code"), (6, "a/b/own.py", f"one two three four five six seven\n{apache}\nand code follows here"),
        (7, None, None), (8, "a", ""), (2, "a/b/x.py", "code"), (9, "a/a-LICENSE", apache), (None, "a/q", "word " * 100_000),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string").selectExpr("*", "1 as row", "2 as size", "3 as word")
    got = [(r.doc_id, r.license, r.origin, r.source_path) for r in op.inherited(op.scan(frame)).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "MIT", "file", "a/LICENSE"), (2, "MIT", "inherited", "a/LICENSE"), (2, "MIT", "inherited", "a/LICENSE"),
        (3, "Apache-2.0", "file", "a/b/c/COPYING"), (4, "Apache-2.0", "inherited", "a/b/c/COPYING"), (5, None, "none", None),
        (6, "Apache-2.0", "header", "a/b/own.py"), (7, None, "none", None), (8, None, "none", None),
        (9, "Apache-2.0", "file", "a/a-LICENSE"), (None, "MIT", "inherited", "a/LICENSE"),
    ], key=str)
    assert op.inherited(op.scan(frame.where("false"))).count() == 0


GPL = """# Copyright 2020 Someone
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
import os
"""
APACHE = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */
int main() { return 0; }
"""


def test_usual_headers_and_files(spark):
    """Wrapped headers, whole files, titles and identifiers among documents of other words, some with a title's words."""
    mit = "\n\n".join(["MIT License", "Copyright (c) 2020 Someone", *(t for name, t in op.PARAGRAPHS if name == "MIT")])
    mit = re.sub(r"(.{50,70}) ", r"\1\n", mit)
    cases = {
        1: (GPL, "GPL-3.0"), 2: (GPL.replace("version 3", "version 2"), "GPL-2.0"), 3: (APACHE, "Apache-2.0"), 4: (mit, "MIT"),
        5: ("The MIT License (MIT)\n\ncode", "MIT"), 6: ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
        7: ("// SPDX-License-Identifier: MIT-0\nint x;", "MIT-0"), 8: ("# SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"),
        9: ("# SPDX-License-Identifier: Unknown-1.0", None), 10: ("MIT", None), 11: ("License", None),
        12: ("Wir fahren mit dem Zug.\nDie Version 2.0 kam mit neuen Funktionen.", None),
        13: ("GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\nPreamble", "GPL-3.0"), 14: ("You need a license to drive a car.", None),
        15: (GPL.replace("GNU General", "GNU Affero General"), "AGPL-3.0"), 16: (GPL.replace("\n# ", " "), "GPL-3.0"),
    }
    docs = {i: text for i, (text, _) in cases.items()} | {100 + i: f"some row of plain words number {i} with mit and version" for i in range(300)}
    frame = spark.createDataFrame([(i, f"f/{i}.txt", t) for i, t in docs.items()], "doc_id long, path string, text string")
    rows = {r.doc_id: r for r in op.scan(frame).collect()}
    assert {i: rows[i].license for i in cases} == {i: name for i, (_, name) in cases.items()}
    assert all(rows[i].license is None for i in docs if i >= 100)
    assert rows[4].is_file and rows[5].is_file is True and not rows[12].is_file
    want = brute(docs)
    assert {i: (r.license, r.score and round(r.score, 6)) for i, r in rows.items()} == want
