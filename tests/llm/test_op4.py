"""Shards: law, slots and curve against plain Python."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from demandspark.llm import op4_sharding as op
from demandspark.llm.registry import QUERIES


def check(rows, docs):
    assert sorted(((r.doc_id is None, r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        ((i is None, i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(16)]
    assert set(slots) <= set(range(16)) and max(sizes) - min(sizes) <= 1
    cut = defaultdict(set)
    for r in rows:
        cut[(r.size, r.text_crc32)].add(r.shard)
    assert sum(len(s) - 1 for s in cut.values()) <= 15


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = QUERIES["op4_sharding"][0](spark, folder).collect()
    check(rows, docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_edge_rows(spark):
    docs = [(i, "same") for i in range(50)] + [(50, None), (51, ""), (None, "x"), (53, "é" * 90_000), (0, "same")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "if(doc_id % 3 = 0, null, 'en') as lang", "concat('s', doc_id % 4) as source", "1 as size", "2 as shard", "3 as part"
    )
    check(op.document_shards(frame).collect(), docs)
    assert op.document_shards(frame.where("false")).count() == 0


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3)])
def test_curve_visits_every_cell_by_unit_steps(spark, n, bits):
    cells = spark.range(2 ** (n * bits)).select(
        F.array(*(F.shiftright("id", bits * k).bitwiseAND(F.lit(2**bits - 1)).cast("int") for k in range(n))).alias("cell")
    )
    rows = cells.select("cell", op.hilbert_index("cell", n, bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(2 ** (n * bits)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a.cell, b.cell)) == 1


def test_written_shards_prune(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    op.write_shards(op.document_shards(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


def test_strings_with_a_shared_beginning_are_told_apart(spark):
    """Ranks are those of whole strings; a hot value, long ones, nulls and empty ones get cells in their order."""
    key = "case when id % 3 = 0 then 'https://www.example.org/hot' when id % 50 = 1 then null when id % 50 = 4 then '' else concat('https://www.example.org/', lpad(id % 700, 4, '0'), repeat('x', 300)) end"
    df = spark.range(6000).selectExpr("id", f"{key} as source", "'same' as lang")
    rows = op.quantised(df, ["source", "lang"]).collect()
    order = sorted({r.source for r in rows if r.source is not None})
    cells = [{r.cell[0] for r in rows if r.source == value} for value in order]
    assert all(len(c) == 1 for c in cells) and cells == sorted(cells, key=min)
    assert len(set.union(*cells)) > 15 and {r.cell[1] for r in rows} == {0}
    assert {r.cell[0] for r in rows if r.source is None} == {0}
    assert {len(r.cell) for r in op.quantised(df.where("source is null"), ["source"]).collect()} == {1}
