"""Fingerprints and links against plain Python."""

import numpy as np
import pytest
import xxhash

from demandspark.llm import op1_simhash as op
from demandspark.llm.registry import QUERIES


def brute(rows, size=3, radius=2):
    prints = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        pieces = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
        h = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ values[k]) <= radius):
            a, b = find(i), find(ids[j])
            root[max(a, b)] = min(a, b)
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def test_query_against_plain_python(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r[0]: (r[1], r[2]) for r in QUERIES["op1_simhash"][0](spark, folder).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize(("tile", "side"), [(4096, 64), (4096, 3), (8, 2)])
def test_edge_rows_and_small_tiles(spark, monkeypatch, tile, side):
    monkeypatch.setattr(op, "TILE", tile)
    monkeypatch.setattr(op, "SIDE", side)
    rng = np.random.default_rng(1)
    base = [" ".join(rng.choice(list("abcdefgh"), 30)) for _ in range(12)]
    rows = [(i, base[i % 12] + (" x" if i % 5 == 0 else "")) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "Two Words"), (204, "two words"), (205, "One"), (205, "One")]
    rows += [(206, "lorem " * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as word", "2 as own", "3 as ROOT")
    got = op.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        assert (f"{r.word & (2**64 - 1):016x}", r.component_id) == want[r.doc_id]


@pytest.mark.parametrize(("tile", "side", "radius"), [(4096, 64, 3), (4096, 7, 4), (64, 5, 2), (4096, 16, 9), (32, 16, 9)])
def test_links_of_random_words(spark, monkeypatch, tile, side, radius):
    """Clusters of words a few bits apart, against the exclusive-or of all pairs."""
    monkeypatch.setattr(op, "TILE", tile)
    monkeypatch.setattr(op, "SIDE", side)
    rng = np.random.default_rng(5)
    words = set(rng.integers(0, 1 << 62, 150).tolist()) | {5}
    for w in list(words)[:100] + [5] * 100:
        for b in rng.choice(62, int(rng.integers(1, 4)), replace=False):
            w ^= 1 << int(b)
        words.add(w)
    frame = spark.createDataFrame([(w,) for w in words], "word long")
    root = {w: w for w in words}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(pairs):
        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {w: find(w) for w in words}

    got = join([tuple(r) for r in op.links(frame, radius).collect()])
    root.update({w: w for w in words})
    assert got == join([(a, b) for a in words for b in words if a < b and (a ^ b).bit_count() <= radius])


def test_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (1, "a b c")], "doc_id long, text string")
    assert sorted(map(str, (r.component_id for r in op.near_duplicates(docs).collect()))) == ["1", "None"]
    assert op.near_duplicates(docs.where("false")).count() == 0
    assert op.deduplicated(docs.where("false")).count() == 0


def test_one_row_of_each_component_stays(spark):
    rows = [(1, "a b c d e"), (1, "unlike text of its own"), (1, "A b c  d e"), (2, "a b c d e"), (3, "another text here now")]
    rows += [(3, "another text here now"), (4, ""), (5, None), (None, "a b c d e"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as own", "2 as number", "map('k', 1) as m")
    kept = op.deduplicated(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or 0, (r.text or "").lower().split()) for r in kept.collect()))
    assert got == [(0, []), (0, "a b c d e".split()), (1, "a b c d e".split()), (1, "unlike text of its own".split()),
                   (3, "another text here now".split()), (4, [])]
