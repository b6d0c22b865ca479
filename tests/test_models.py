import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import linear, metrics, split, validation


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small data would be merged into one slice; keep the slices apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def frame(spark, x, y, **extra):
    names = [f"x{i}" for i in range(x.shape[1])]
    cols = [x[:, i].tolist() for i in range(x.shape[1])] + [y.tolist()] + [np.asarray(v).tolist() for v in extra.values()]
    rows = list(zip(range(len(y)), *cols))
    return spark.createDataFrame(rows, ["t", *names, "y", *extra]).repartition(4), names


def lstsq(x, y):
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.linalg.lstsq(xc, yc, rcond=1e-10)[0]
    return y.mean() - x.mean(0) @ beta, beta


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(203, 4)) * [1, 10, 0.1, 3] + [100, 0, -5, 1000]
    y = x @ [1.5, -0.2, 4.0, 0.05] + rng.normal(size=203) + 30
    return x, y


def test_ols_equals_numpy(spark, data):
    df, names = frame(spark, *data)
    row = linear.fit_ols(df, names, "y").first()
    intercept, beta = lstsq(*data)
    assert row["n_rows"] == 203
    assert row["intercept"] == pytest.approx(intercept, rel=1e-9)
    assert row["coef"] == pytest.approx(beta, rel=1e-8)


@pytest.mark.parametrize("case", ["constant", "twins", "few rows", "scaled twin"])
def test_minimum_norm_fit(spark, data, case):
    x, y = data
    if case == "constant":
        x = np.column_stack([x, np.full(len(y), 2023.0)])
    elif case == "twins":
        x = np.column_stack([x, x[:, 0]])
    elif case == "scaled twin":
        x = np.column_stack([x, 1 - x[:, 1] / 7])
    else:
        x, y = x[:4], y[:4]
    df, names = frame(spark, x, y)
    row = linear.fit_ols(df, names, "y").first()
    intercept, beta = lstsq(x, y)
    assert row["coef"] == pytest.approx(beta, rel=1e-5, abs=1e-7)
    assert row["intercept"] == pytest.approx(intercept, rel=1e-5)


def test_standardised_fit_and_prediction(spark, data):
    df, names = frame(spark, *data)
    x, y = data
    z = (x - x.mean(0)) / x.std(0)
    intercept, beta = lstsq(z, y)
    model = linear.fit_ols(df, names, "y", standardize=True)
    row = model.first()
    assert row["intercept"] == pytest.approx(intercept) and row["coef"] == pytest.approx(beta, rel=1e-8)
    assert row["scale"] == pytest.approx(x.std(0)) and row["mean"] == pytest.approx(x.mean(0))
    got = linear.predict(df, model, names).orderBy("t").collect()
    assert [r["y_pred"] for r in got] == pytest.approx(list(intercept + z @ beta))


def test_scaler_and_standardised_rows_agree(spark, data):
    df, names = frame(spark, *data)
    scaler = linear.fit_scaler(df.withColumn("c", F.lit(3.0)), [*names, "c"])
    assert scaler.scale[-1] == 1.0
    scaled = linear.apply_scaler(df.withColumn("c", F.lit(3.0)), scaler)
    row = scaled.agg(F.avg("x0"), F.stddev_pop("x1"), F.max("c")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 0.0


def test_models_per_key(spark, data):
    x, y = data
    city = np.where(np.arange(len(y)) % 3 == 0, "a", "hot")
    df, names = frame(spark, x, y, city=city)
    got = {r["city"]: r for r in linear.fit_ols_by(df, "city", names, "y").collect()}
    assert set(got) == {"a", "hot"}
    for c in got:
        xs, ys = x[city == c], y[city == c]
        intercept, beta = lstsq((xs - xs.mean(0)) / xs.std(0), ys)
        assert got[c]["intercept"] == pytest.approx(intercept)
        assert [got[c][n] for n in names] == pytest.approx(list(beta), rel=1e-7)


def test_factors_of_groups_stack_up(spark, data, monkeypatch):
    df, names = frame(spark, *data)
    folded = df.withColumn("fold", F.when(F.col("t") % 5 > 0, F.col("t") % 5))  # one key is NULL
    total = linear.as_factor(linear.factors(folded, names, "y").first())
    rows = linear.factors(folded, names, "y", ["fold"]).collect()
    assert {r["fold"] for r in rows} == {None, 1, 2, 3, 4}
    both = linear.stacked([linear.as_factor(r) for r in rows])
    z = np.column_stack([np.ones(len(data[1])), *data[0].T, data[1]])
    for f in (total, both):
        moved = f.moved(np.zeros(5))
        assert f.n == 203 and np.allclose(moved.T @ moved, z.T @ z)


def test_nearly_collinear_features_keep_their_digits(spark):
    """Normal equations square the condition (1e7 here) and would take these for one feature."""
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=400), rng.normal(size=400)
    x = np.column_stack([a, a + 1e-7 * b])
    df, names = frame(spark, x, 2 * a + 3 * x[:, 1] + 5)
    row = linear.fit_ols(df, names, "y").first()
    assert row["coef"] == pytest.approx([2, 3], rel=1e-6)


def rmse(a, b):
    return float(np.sqrt(np.mean((a - b) ** 2)))


def test_kfold_equals_numpy(spark, data):
    x, y = data
    df, names = frame(spark, x, y)
    scores = validation.kfold_cv(df, names, "y", ["t"], 10).orderBy("fold").collect()
    folds = np.array_split(np.arange(len(y)), 10)
    assert [r["n_test"] for r in scores] == [len(f) for f in folds]
    for r, f in zip(scores, folds):
        rest = np.setdiff1d(np.arange(len(y)), f)
        a, b = lstsq(x[rest], y[rest])
        assert r["rmse"] == pytest.approx(rmse(y[f], a + x[f] @ b), rel=1e-8)


def test_expanding_equals_numpy(spark, data):
    x, y = data
    df, names = frame(spark, x, y)
    scores = validation.expanding_cv(df, names, "y", ["t"], 10).orderBy("fold").collect()
    size = len(y) // 11
    start = len(y) - 10 * size
    for i, r in enumerate(scores):
        cut = start + i * size
        a, b = lstsq(x[:cut], y[:cut])
        test = slice(cut, cut + size)
        assert (r["fold"], r["n_train"], r["n_test"]) == (i + 1, cut, size)
        assert r["rmse"] == pytest.approx(rmse(y[test], a + x[test] @ b), rel=1e-8)
        assert r["coef"] == pytest.approx(b, rel=1e-6)


def test_folds_of_equal_rows(spark):
    df = spark.createDataFrame([(i // 60, float(i // 30), float(i // 30)) for i in range(240)], "t int, x double, y double")
    cut = validation.with_folds(df.repartition(6), ["t"], {"fold": validation.kfold_starts(240, 7), "block": validation.expanding_starts(240, 7)})
    assert [r["count"] for r in cut.groupBy("fold").count().orderBy("fold").collect()] == [35, 35, 34, 34, 34, 34, 34]
    assert [r["count"] for r in cut.groupBy("block").count().orderBy("block").collect()] == [30] * 8
    edges = cut.groupBy("fold").agg(F.min("t").alias("a"), F.max("t").alias("b")).orderBy("fold").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(edges, edges[1:]))


def test_too_few_rows_for_the_folds(spark, data):
    df, names = frame(spark, data[0][:8], data[1][:8])
    with pytest.raises(ValueError):
        validation.kfold_cv(df, names, "y", ["t"], 10)
    with pytest.raises(ValueError):
        validation.expanding_cv(df, names, "y", ["t"], 10)


def test_scores(spark):
    rows = [(0.0, 1.0), (2.0, 1.5), (4.0, 5.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    y, p = np.array(rows).T
    row = metrics.regression_metrics(df, "y", "p").first()
    deviance = 2 * np.mean([1.0, *(y[1:] * np.log(y[1:] / p[1:]) - y[1:] + p[1:])])
    want = [np.mean((y - p) ** 2), rmse(y, p), np.mean(abs(y - p)), 1 - np.mean((y - p) ** 2) / y.var(), deviance]
    assert list(row) == pytest.approx(want)


def test_scores_of_a_constant_target(spark):
    df = spark.createDataFrame([(2.0, 2.0, 1.0), (2.0, 2.0, 3.0)], "y double, p double, q double")
    assert metrics.regression_metrics(df, "y", "p", ["r2"]).first()[0] == 1.0
    assert metrics.regression_metrics(df, "y", "q", ["r2"]).first()[0] == 0.0


@pytest.mark.parametrize("y,p", [(0.0, 0.0), (-1.0, 2.0)])
def test_poisson_deviance_refuses_bad_values(spark, y, p):
    df = spark.createDataFrame([(y, p)], "y double, p double")
    with pytest.raises(Exception, match="Poisson deviance"):
        metrics.regression_metrics(df, "y", "p", ["poisson"]).collect()


@pytest.mark.parametrize(("n", "share", "wanted"), [(20_000, 0.2, 4000), (20_001, 0.125, 2501), (7, 0.2, 2), (1, 0.5, 1), (0, 0.2, 0)])
def test_split_is_exact(spark, n, share, wanted):
    train, test = split.hash_split(spark.range(n).withColumn("k", F.col("id").cast("string")), ["k"], share)
    assert (train.count(), test.count()) == (n - wanted, wanted)


def test_split_of_equal_keys_and_rows_is_exact(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") < 500, F.col("id")).alias("v")).repartition(5)
    train, test = split.hash_split(df, ["k"], 0.37)
    assert (train.count(), test.count()) == (630, 370)
    assert train.unionAll(test).exceptAll(df).count() == 0


def test_split_is_stable(spark):
    df = spark.range(20000).withColumn("k", F.col("id").cast("string"))
    test = split.hash_split(df, ["k"])[1]
    again = split.hash_split(df.repartition(13), ["k"])[1]
    assert test.exceptAll(again).count() == 0
    assert split.hash_split(df, ["k"], seed=1)[1].exceptAll(test).count() > 0
