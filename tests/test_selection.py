"""Order statistics against Spark's own sort."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandspark.operators import selection
from demandspark.plans import studies
from demandspark.sources import scratch

SCHEMA = "i int, l long, d date, t timestamp, x double, s string, b boolean, m decimal(30,4), u string"


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(9)
    numbers = [0.0, -1.5, float("nan"), float("inf"), float("-inf"), 1e300, -1e300, 1e-300]
    rows = []
    for k in range(700):
        row = (
            int(rng.integers(-5, 5)), int(rng.integers(-(2**63), 2**63 - 1)), dt.date(2024, 1, 1) + dt.timedelta(int(rng.integers(-9, 9))),
            dt.datetime(1969, 12, 31, 23) + dt.timedelta(microseconds=int(rng.integers(0, 10**10))), numbers[int(rng.integers(0, 8))],
            ["", "a", "ab", "abcdefgh", "abcdefgi", "zürich", "é" * 9][int(rng.integers(0, 7))], bool(rng.integers(0, 2)),
            Decimal(int(rng.integers(-(10**15), 10**15))) / 10000, f"u{k}",
        )
        rows.append(tuple(None if j < 8 and rng.random() < 0.08 else v for j, v in enumerate(row)))
    return scratch.materialize(spark.createDataFrame(rows, SCHEMA).repartition(4), "mixed")


@pytest.mark.parametrize(
    ("order", "buckets"), [(["i", "u"], 8192), (["l"], 40), (["d", "t"], 8192), (["x", "u"], 40), (["s", "l", "u"], 60), (["b", "m", "u"], 8192)]
)
def test_cuts_are_those_of_a_sort(spark, monkeypatch, mixed, order, buckets):
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    ranks = [0, 1, 99, 100, 350, 698, 699]
    keys = selection.digits(mixed, order)
    cut = selection.cut_rows(mixed, keys, {"part": selection.order_statistics(mixed, keys, ranks)})
    place = F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_last() for c in order], F.xxhash64(*mixed.columns))) - 1
    want = cut.withColumn("want", sum((place >= r).cast("int") for r in ranks))
    if order == ["l"]:  # several rows without a key: NULL rows are ordered by content, as digits of the hash are
        want = want.where("l is not null")
    assert want.where("part <> want").count() == 0
    assert cut.groupBy("part").count().count() == len(ranks)


def test_ranks_outside_are_refused(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        selection.order_statistics(df, selection.digits(df, ["id"]), [3])


def test_equal_rows_are_parted_by_number(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(2,)] * 30 + [(None,)] * 20, "a int").repartition(3)
    keys = selection.digits(df, ["a"])
    ranks = [7, 20, 50, 95]
    cut = selection.cut_rows(df, keys, {"p": selection.order_statistics(df, keys, ranks), "q": selection.order_statistics(df, keys, [60])})
    assert {r["p"]: r["count"] for r in cut.groupBy("p").count().collect()} == {0: 7, 1: 13, 2: 30, 3: 45, 4: 5}
    assert {r["q"]: r["count"] for r in cut.groupBy("q").count().collect()} == {0: 60, 1: 40}


def test_a_study_sorts_and_writes_nothing(spark, folder, monkeypatch):
    from checks.inputs import training_full

    training = scratch.materialize(training_full(spark, folder), "training")
    earlier, seen = scratch.written(), []
    monkeypatch.setattr(studies, "_scores", lambda rows, *rest, scores=studies._scores: (seen.append(rows), scores(rows, *rest))[1])
    assert studies.third_daily_study(training).count() > 50
    assert scratch.written() == earlier
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
