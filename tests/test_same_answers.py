"""Both plans of an ordered operator agree row by row; models and grids keep their rows and digits."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import hourly, linear, smoothing, windows


def same(a, b):
    return a == b or (a is not None and b is not None and (math.isclose(a, b, rel_tol=1e-9) or a != a and b != b))


def by_row(df, name):
    return {r.id: r[name] for r in df.collect()}


@pytest.fixture(scope="module")
def tied(spark):
    return spark.range(120).selectExpr("id", "if(id % 7 = 0, null, id % 3) as k", "id % 4 as o", "double(id * 37 % 11) as x")


def test_ties_are_placed_alike(tied):
    for f in (
        lambda s: windows.seq_num(tied, ["k"], ["o"], "out", strategy=s),
        lambda s: windows.rolling_mean(tied, "x", ["o"], 3, ["k"], "out", strategy=s, block=8),
        lambda s: smoothing.ema(tied, "x", 0.5, ["k"], ["o"], "out", False, strategy=s),
    ):
        plain, ranged = by_row(f("window"), "out"), by_row(f("ranged"), "out")
        assert len(plain) == 120 and all(same(plain[i], ranged[i]) for i in plain)


@pytest.mark.parametrize(
    "odd",
    [{10: math.nan}, {10: math.inf}, {3: math.inf, 2500: -math.inf}, {0: -math.inf}, {4000: math.nan, 1000: math.inf}, {0: None}],
)
def test_values_that_are_not_finite_stay(spark, odd):
    alpha, n = 0.5, 5000
    rows = [("a", i, odd.get(i, float(i % 13))) for i in range(n)] + [("b", i, 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, id int, x double")
    got = smoothing.ema(df, "x", alpha, ["k"], ["id"], "out", False).where("k = 'a'")
    found, e = by_row(got, "out"), odd.get(0, 0.0)
    for i in range(n):
        x = odd.get(i, float(i % 13))
        if odd.get(0, 0.0) is not None:
            e = alpha * x + alpha * e if i else 2 * alpha * x
        assert same(found[i], e), (i, found[i], e)
    assert {r.out for r in smoothing.ema(df, "x", alpha, ["k"], ["id"], "out", False).where("k = 'b'").collect()} == {1.0}


def test_window_strategy_refuses_long_series(spark):
    df = spark.range(1200).selectExpr("id", "1 as k", "double(id) as x")
    with pytest.raises(Exception, match="series is longer"):
        smoothing.ema(df, "x", 0.5, ["k"], ["id"], strategy="window").collect()


def test_incomplete_rows_are_not_learned_from(spark):
    rows = [(i, float(i % 17), None if i % 3 == 0 else float(i * 7 % 23)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double").withColumn("y", F.expr("1 + 2 * a + 3 * coalesce(b, 0)"))
    model = linear.fit_ols(df, ["a", "b"], "y").first()
    assert model.n_rows == 200 and np.allclose([model.intercept, *model.coef], [1, 2, 3], atol=1e-9)
    odd = df.withColumn("a", F.expr("if(id = 1, double('nan'), a)"))
    model = linear.fit_ols(odd, ["a", "b"], "y", ["id"]).where("id in (0, 1)")
    assert model.count() == 0
    assert np.allclose(linear.fit_ols(odd, ["a", "b"], "y").first().coef, [2, 3], atol=1e-9)


def test_groups_of_any_size_keep_their_slope(spark):
    rows = [(k, base + x, 5 + 2 * x) for k, base in (("far", 5e7), ("near", 0.0), (None, -3e9)) for x in (1.0, 2.0, 3.0, 2.5)]
    df = spark.createDataFrame(rows, "k string, a double, y double")
    for standardize in (False, True):
        models = linear.fit_ols(df, ["a"], "y", ["k"], standardize)
        back = linear.predict(df, models, ["a"], by=["k"]).collect()
        assert len(back) == 12 and all(abs(r.y_pred - r.y) < 1e-4 for r in back)
    assert {round(r.coef[0], 6) for r in linear.fit_ols(df, ["a"], "y", ["k"]).collect()} == {2.0}


def test_no_rows_give_no_model(spark):
    df = spark.createDataFrame([], "k string, a double, y double")
    assert linear.fit_ols(df, ["a"], "y", ["k"]).count() == 0
    with pytest.raises(ValueError, match="no rows to learn from"):
        linear.predict(df, linear.fit_ols(df, ["a"], "y"), ["a"])


def test_a_null_city_keeps_its_hours(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(c, start + dt.timedelta(hours=h), h % 5) for c in ("a", None) for h in range(24 * 8)]
    grid = spark.createDataFrame(rows, "city_destination string, delivery_timestamp timestamp, total_booked int").selectExpr(
        "*", "weekday(delivery_timestamp) + 1 as delivery_timestamp_dow", "hour(delivery_timestamp) as delivery_timestamp_h"
    )
    for pooled in (True, False):
        assert hourly.slot_rolling_means(grid, "2024-12-31", pooled=pooled).count() == len(rows)
