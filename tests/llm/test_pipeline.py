"""Every stage on its own input against plain Python."""

import re

import corpus_pipeline
from demandspark.llm import op9_decontamination, op10_quality
from demandspark.sources import scratch
from test_op1 import brute
from test_op2 import spans
from test_op7 import check
from test_op7 import library as library  # noqa: PLC0414


def test_stages(spark, folder, library, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        new = spark.read.parquet(str(tmp_path / name))
        kept.append((docs, new))
        docs = new
    for before, after in kept[:-1]:
        assert after.schema == before.schema
    rows = [({r.doc_id: r for r in a.collect()}, {r.doc_id: r for r in b.collect()}) for a, b in kept[:4]]

    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    wrong = [i for i in rows[0][0] if i in quality and (i in rows[0][1]) != (quality[i] == 1)]
    assert len(wrong) <= 0.03 * len(quality)

    before, after = rows[1]
    component = {i: c for i, (_, c) in brute([(i, r.text) for i, r in before.items()]).items()}
    assert set(after) == set(component.values()) and len(after) < len(before)

    before, after = rows[2]
    items = [re.findall(r"\w+", r.text.lower()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for i, r in before.items():
        words = " ".join(re.findall(r"\w+", r.text.lower()))
        if any(" ".join(x) in words for x in items):
            assert i not in after
    leaked = op9_decontamination.find(kept[2][0], spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert set(before) - set(after) == {r.doc_id for r in leaked.collect()}

    before, after = rows[3]
    assert set(before) == set(after)
    for i, r in after.items():
        assert not spans(r.text) and r.n_chars == len(r.text)
        if not spans(before[i].text):
            assert r.text == before[i].text

    packed = kept[4][1].collect()
    check(packed, [(i, r.text) for i, r in after.items()], library)
    assert set(packed[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_odd_rows_pass(spark, tmp_path):
    rows = [(1, None), (2, ""), (None, "some text here"), (3, "a b c d e f g"), (3, "a b c d e f g"), (4, "a b c d e f g")]
    rows += [(3, "very long " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' as lang", "'s' as source", "5L as n_chars", "1 as score", "2 as row", "3 as base", "4 as _score", "5 as _own"
    )
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "no such item in any document")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stage = docs
    for _, f in corpus_pipeline.STAGES[:4]:
        stage = f(spark, stage, str(tmp_path))
        assert stage.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in stage.collect()) == [0, 1, 3, 3]
    earlier = scratch.written()
    assert corpus_pipeline.run(spark, str(tmp_path)).where("piece = 0").count() == 4
    assert len(scratch.written() - earlier) == 1
    assert op10_quality.THRESHOLD == 0.3


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, schema in (("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
