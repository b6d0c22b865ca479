"""Scores and predictions where something is missing."""

import pytest

from demandspark.operators import linear, metrics, split


def test_scores_use_rows_with_both_values(spark):
    full = [(1.0, 1.5), (2.0, 2.5), (3.0, 2.0)]
    some = [*full, (1000.0, None), (None, 7.0)]
    a, b = (metrics.regression_metrics(spark.createDataFrame(x, "y double, p double"), "y", "p").first() for x in (full, some))
    assert a == b


def test_rows_of_null_and_unknown_keys_stay(spark):
    rows = [(c, float(x), 2.0 * x + 1) for c in ("a", None) for x in range(6)]
    data = spark.createDataFrame(rows, "city string, x double, y double")
    model = linear.fit_ols(data, ["x"], "y", ["city"])
    new = spark.createDataFrame([("a", 10.0), (None, 10.0), ("z", 10.0)], "city string, x double")
    got = {r.city: r.yhat for r in linear.predict(new, model, ["x"], "yhat", by=["city"]).collect()}
    assert got["a"] == pytest.approx(21) and got[None] == pytest.approx(21) and got["z"] is None


def test_share_must_lie_inside(spark):
    for share in (0, 1, -0.1, 1.5):
        with pytest.raises(ValueError):
            split.hash_split(spark.range(1), ["id"], share)
