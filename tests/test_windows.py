import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandspark.operators import windows as W
from demandspark.operators import smoothing
from demandspark.operators.smoothing import direct_limit, ema, ema_grid
from demandspark.sources import scratch


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small data would be merged into one slice; keep the slices apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; one key is NULL; values have gaps."""
    rng = random.Random(5)
    keys = ["hot"] * 900 + ["a"] * 40 + ["b"] * 3 + [None] * 30
    rows = [(k, i, float(rng.randint(0, 50)) if rng.random() > 0.1 else None) for i, k in enumerate(keys)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, v double").repartition(7)


def test_ranged_row_numbers_equal_window(skewed):
    a = W.seq_num(skewed, ["k"], ["t"], strategy="window")
    b = W.seq_num(skewed, ["k"], ["t"], strategy="ranged")
    assert rows_of(a, "k", "t", "seqnum") == rows_of(b, "k", "t", "seqnum")


def test_global_row_numbers(skewed):
    got = W.ranged_index(skewed, ["t"]).orderBy("t").collect()
    assert [r["seqnum"] for r in got] == list(range(973))


def test_equal_sort_keys_are_spread(spark):
    """All rows share one sort key; they must still fill several slices."""
    df = spark.range(0, 20000, 1, 8).select(F.lit("hot").alias("k"), F.lit(1).alias("t"), F.col("id").alias("v"))
    sliced = W.in_slices(df, ["k"], ["t"])
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 20000 and max(sizes) < 10000
    numbered = W.ranged_index(df, ["t"], ["k"])
    assert numbered.agg(F.count_distinct("seqnum"), F.max("seqnum")).first()[:] == (20000, 19999)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string, t int, v double")
    assert W.ranged_index(empty, ["t"]).count() == 0
    assert W.rolling_mean(empty, "v", ["t"], 3).count() == 0
    assert W.seq_num(empty, ["k"], ["t"]).count() == 0


@pytest.mark.parametrize("block", [7, 8, 50, 5000])
def test_block_rolling_mean_equals_window(skewed, block):
    w = Window.orderBy("t").rowsBetween(-6, 0)
    plain = skewed.withColumn("m", F.avg("v").over(w))
    blocked = W.rolling_mean(skewed, "v", ["t"], 6, out="m", block=block)
    assert rows_of(plain, "t", "m") == rows_of(blocked, "t", "m")


def test_block_rolling_mean_by_key(skewed):
    w = Window.partitionBy("k").orderBy("t")
    plain = skewed.withColumns({"m": F.avg("v").over(w.rowsBetween(-2, 0)), "n": F.avg("v").over(w.rowsBetween(-9, 0))})
    blocked = W.rolling_means(skewed, "v", {"m": 2, "n": 9}, ["t"], ["k"], "ranged", block=16)
    assert rows_of(plain, "k", "t", "m", "n") == rows_of(blocked, "k", "t", "m", "n")


def test_frame_longer_than_data(skewed):
    got = W.rolling_mean(skewed, "v", ["t"], 5000, out="m", block=10)
    want = skewed.withColumn("m", F.avg("v").over(Window.orderBy("t").rowsBetween(-5000, 0)))
    assert rows_of(got, "t", "m") == rows_of(want, "t", "m")


def test_running_sum_counts_equal_positions_together(spark, skewed):
    tied = skewed.withColumn("g", F.col("t") % 37)
    a = W.running_sum(tied, "v", ["k"], "g", "s", "window")
    b = W.running_sum(tied, "v", ["k"], "g", "s", "ranged")
    assert rows_of(a, "k", "t", "s") == rows_of(b, "k", "t", "s")


def test_prev_edge_plans_agree(skewed):
    a = W.prev_edge(skewed, "t", ["k"], -1, "p", "window")
    b = W.prev_edge(skewed, "t", ["k"], -1, "p", "ranged")
    assert rows_of(a, "k", "t", "p") == rows_of(b, "k", "t", "p")


def test_top_per_group_breaks_ties_and_limits_early(spark, skewed):
    rows = [("x", "b", 5), ("x", "a", 5), ("x", "c", 1), ("y", "z", None), ("y", "q", 0)]
    df = spark.createDataFrame(rows, "k string, n string, v int").repartition(3)
    top = W.top_per_group(df, ["k"], [F.col("v").desc_nulls_last(), "n"])
    assert rows_of(top, "k", "n") == [("x", "a"), ("y", "q")]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def recurrence(values, alpha):
    if values[0] is None:
        return [None] * len(values)
    e, out = values[0], []
    for v in values:
        e = alpha * (e + (v or 0.0))
        out.append(e)
    return out


@pytest.mark.parametrize("alpha", [0.3, 0.5, 0.7, 0.97])
def test_smoothing_equals_recurrence_on_long_series(spark, alpha):
    rng = random.Random(1)
    values = [float(rng.randint(0, 100)) if i % 11 else None for i in range(1, 3001)]
    values[0] = 42.0
    rows = [("long", i, v) for i, v in enumerate(values)] + [("gap", 0, None), ("gap", 1, 4.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(5)
    got = {(r["k"], r["t"]): r["e"] for r in ema(df, "v", alpha, ["k"], ["t"], "e", rounded=False).collect()}
    assert got[("gap", 0)] is None and got[("gap", 1)] is None
    for i, want in enumerate(recurrence(values, alpha)):
        assert got[("long", i)] == pytest.approx(want, rel=1e-12)


def test_direct_and_block_smoothing_agree(skewed):
    outputs = {"e3": ("v", 0.3), "e7": ("v", 0.7)}
    few = skewed.filter("t < 300")
    a = ema_grid(few, outputs, ["k"], ["t"], strategy="window")
    b = ema_grid(few, outputs, ["k"], ["t"], strategy="ranged")
    assert rows_of(a, "k", "t", "e3", "e7") == rows_of(b, "k", "t", "e3", "e7")


def test_far_apart_factors_share_blocks(spark, monkeypatch):
    """Blocks are as short as the quick factor needs, and the slow one still reaches over all of them."""
    monkeypatch.setattr(smoothing, "_FAN", 4)
    values = [float(i * 31 % 17) for i in range(6000)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)] + [(None, 0, 3.0), (None, 1, 1e200)], "k string, t int, v double")
    outputs = {f"e{round(a * 1000)}": ("v", a) for a in (0.001, 0.5, 0.999)}
    rows = ema_grid(df, outputs, ["k"], ["t"], rounded=False).collect()
    for out, (_, a) in outputs.items():
        got = {(r["k"], r["t"]): r[out] for r in rows}
        assert [got["a", i] for i in range(6000)] == pytest.approx(recurrence(values, a), rel=1e-11)
        assert got[None, 1] == pytest.approx(a * 1e200 + a * a * 6.0)


def test_affine_scan_over_levels(spark, monkeypatch):
    monkeypatch.setattr(smoothing, "_FAN", 3)
    c = [float(i % 5) for i in range(100)]
    c[70] = float("inf")
    df = spark.createDataFrame([("x", i, v) for i, v in enumerate(c)] + [(None, 0, 9.0)], "k string, n int, c double")
    got = {(r.k, r.n): r.c for r in smoothing.affine_scan(df, ["k"], "n", {"c": 1e-20}).collect()}
    e = 0.0
    for i, v in enumerate(c):
        assert got["x", i] == pytest.approx(e, rel=1e-12)
        e = 1e-20 * e + v
    assert got[None, 0] == 0.0 and len(got) == 101


def test_direct_limit_keeps_powers_finite():
    assert (1 / 0.3) ** (direct_limit([0.3, 0.7]) + 1) < 1e300
    with pytest.raises(ValueError):
        direct_limit([1.0])


def test_half_is_rounded_up_after_smoothing(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0)], "k string, t int, v double")
    assert [r["e"] for r in ema(df, "v", 0.5, ["k"], ["t"], "e").orderBy("t").collect()] == [1.0, 2.0]


def test_numbers_across_slices_without_a_written_copy(spark):
    """One key holds a third of the rows, another is NULL; repeated rows are numbered too."""
    key = "if(id % 3 = 0, 'hot', if(id % 3 = 1, null, concat('key number ', id % 200))) as k"
    df = spark.range(30_000).unionAll(spark.range(3000)).selectExpr(key, "int(id % 977) as o", "double(id % 5) as x")
    before = scratch.written()
    ranged = W.ranged_index(df, ["o"], ["k"], "n", first_of=["x"])
    assert scratch.written() == before
    rows = ranged.collect()
    assert len(rows) == 33_000
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append(r)
    plain = {(r.k, r.n): (r.o, r.x) for r in W.seq_num(df, ["k"], ["o"], "n", strategy="window").collect()}
    for k, group in by_key.items():
        group.sort(key=lambda r: r.n)
        assert [r.n for r in group] == list(range(len(group)))
        assert all((r.o, r.x) == plain[k, r.n] for r in group)
        assert {r._first_x for r in group} == {group[0].x}
    whole = sorted(W.ranged_index(df, ["k", "o"], out="n").collect(), key=lambda r: r.n)
    assert [r.n for r in whole] == list(range(33_000))
    keys = [(r.k is None, r.k or "", r.o) for r in whole]
    assert keys == sorted(keys)


def test_order_of_odd_values(spark):
    from decimal import Decimal

    values = [None, float("nan"), float("inf"), -float("inf"), 0.0, -1.5, 1e300, 2.5]
    rows = [(v, Decimal(i % 3) - Decimal("0.25"), i) for i, v in enumerate(values * 40)]
    df = spark.createDataFrame(rows, "v double, d decimal(9,2), i int")
    got = [r.i for r in W.ranged_index(df, ["v", "d", "i"], out="n").orderBy("n").collect()]
    want = [r.i for r in df.orderBy(F.col("v").asc_nulls_last(), "d", "i").collect()]
    assert got == want
