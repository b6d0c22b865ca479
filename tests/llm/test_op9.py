"""Seeds and alignments against a full search."""

import numpy as np
import pytest

from demandspark.llm import op9_decontamination as op
from demandspark.llm.registry import QUERIES


def full_alignment(item, words):
    h = np.zeros((len(item) + 1, len(words) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a == b else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_scores():
    rng = np.random.default_rng(1)
    for _ in range(60):
        item, words = rng.integers(1, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 30))
        score, first, last = op.located(item, words)
        assert score == full_alignment(item, words) == (full_alignment(item, words[first:last]) if score else 0)


def test_query_against_full_search(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    words = {i: op._WORD.findall(t.lower()) for i, t in items}
    number = {w: k for k, w in enumerate(sorted({w for x in words.values() for w in x}), 1)}
    want = set()
    for doc, text in docs:
        ids = np.array([number.get(w, 0) for w in op._WORD.findall(text.lower())])
        for item, own in words.items():
            if np.isin([number[w] for w in own], ids).mean() >= op.SCORE:
                score, _ = op.align(np.array([number[w] for w in own]), ids)
                if score >= max(op.SCORE * len(own), min(op.LEAST, len(own))):
                    want.add((doc, item, round(score / len(own), 6)))
    rows = QUERIES["op9_decontamination"][0](spark, folder).collect()
    assert {(r.doc_id, r.item_id, round(r.score, 6)) for r in rows} == want and want


@pytest.mark.parametrize("items_in_block", [2000, 1])
def test_edge_rows(spark, monkeypatch, items_in_block):
    monkeypatch.setattr(op, "BLOCK_ITEMS", items_in_block)
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in rng.integers(0, 500, 40)]
    edited = words.copy()
    edited[7], edited[20] = "new", "other"
    filler = " ".join(f"f{k}" for k in rng.integers(0, 900, 30_000))
    rows = [
        (1, f"{filler} {' '.join(words)} {filler}"), (2, " ".join(edited).upper()), (3, " ".join(words[:15])), (4, None),
        (5, ""), (None, " ".join(words)), (6, " ".join(words)), (6, " ".join(words)), (7, "Short, item"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as item_id", "1 as code", "2 as n")
    items = [(10, " ".join(words)), (11, None), (12, ""), (13, "short item"), (14, "?!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id or 0), r.item_id) for r in op.find(docs, bench).collect())
    assert got == [(0, 10), (1, 10), (2, 10), (6, 10), (6, 10), (7, 13)]
    kept = op.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert op.find(docs, bench.where("false")).count() == 0 and op.find(docs.where("false"), bench).count() == 0
    passage = next(r for r in op.find(docs, bench).collect() if r.doc_id == 1)
    assert rows[0][1][passage.start : passage.end] == " ".join(words)


@pytest.mark.parametrize("size", [9, 13, 18, 24, 39, 60])
def test_lone_edited_copies(spark, size):
    rng = np.random.default_rng(size)
    items, rows, want = [], [], set()
    for k in range(60):
        item = [f"i{size}_{k}_{w}" for w in range(size)]
        items.append((k, " ".join(item)))
        copy = []
        every, kind = 5 + k % 4, k // 4 % 4  # substituted, left out, put in, or all of these
        for place, word in enumerate(item):
            edit = (kind if kind < 3 else int(rng.integers(3))) if place % every == every - 1 else None
            copy += [f"new{k}_{place}"] if edit == 0 else [] if edit == 1 else [word, f"new{k}_{place}"] if edit == 2 else [word]
        number = {w: n for n, w in enumerate(item, 1)}
        score = full_alignment([number[w] for w in item], [number.get(w, 0) for w in copy])
        if score >= max(op.SCORE * size, min(op.LEAST, size)):
            want.add((k, k, score))
        rows.append((k, " ".join(["own words", *copy, "more own words"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id, round(r.score * size)) for r in op.find(docs, bench).collect()} == want and want
    kept = {r.doc_id for r in op.without_leaks(docs, bench).collect()}
    assert kept == set(range(60)) - {k for k, _, _ in want}
