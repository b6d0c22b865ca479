"""Quality scores: held-out accuracy, folds, and edge rows."""

import zlib

import numpy as np

from demandspark.llm import op10_quality as op
from demandspark.llm.registry import QUERIES

SCALE = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_fold(spark):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SCALE}/labels.parquet").collect()}
    rows = QUERIES["op10_quality"][0](spark, SCALE).collect()
    assert len(rows) == spark.read.parquet(f"{SCALE}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([r.predicted == quality[r.doc_id] for r in tested]) > 0.95


def test_features_are_those_of_each_word_alone():
    words = ["é", "the", "x" * 300, "中文字", "the"]
    numbers, buckets = op.features(words)
    for k, word in enumerate(words):
        alone = op.features([word])[1]
        assert sorted(buckets[numbers == k]) == sorted(alone)
        assert len(alone) == 1 + sum(max(0, len(word) + 3 - n) for n in op.GRAMS)


def test_edge_rows(spark):
    rows = [(i, "good words here" if i % 2 else "bad### bad### bad###") for i in range(60)]
    odd = [(100, None), (101, ""), (102, " \n"), (None, "good words"), (103, "z" * 200_000), (103, "z" * 200_000)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").selectExpr("*", "1 as score", "2 as quality")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (7, None), (999, 0)], "doc_id long, quality int")
    model = op.fit(docs, labels)
    got = op.score(docs, *model).collect()
    assert len(got) == len(rows) + len(odd)
    score = {r.doc_id: r.score for r in got}
    assert score[1] > 0.9 and score[0] < 0.1 and score[100] == score[101] == score[102]
    nothing = op.score(docs, *op.fit(docs, labels.where("false"))).collect()
    assert {r.score for r in nothing} == {0.5}
    assert op.score(docs.where("false"), *model).count() == 0
