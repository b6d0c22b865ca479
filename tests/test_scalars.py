import datetime as dt
import math

from pyspark.sql import functions as F

from demandspark.functions import scalars as fn


def one(spark, expr, value, type_):
    return spark.createDataFrame([(value,)], f"x {type_}").select(expr.alias("y")).first()["y"]


def test_iso_calendar(spark):
    days = [dt.date(2023, 1, 1), dt.date(2024, 12, 30), dt.date(2024, 6, 2)]
    df = fn.calendar_features(spark.createDataFrame([(d,) for d in days], "d date"), ["d"])
    got = {r["d"]: (r["d_y"], r["d_w"], r["d_d"]) for r in df.collect()}
    assert got == {d: (d.year, d.isocalendar()[1], d.isoweekday()) for d in days}


def test_elapsed_days_cut_toward_zero(spark):
    rows = [
        (dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1), 0),
        (dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2, 1), 1),
        (dt.datetime(2024, 1, 2, 1), dt.datetime(2024, 1, 1, 2), 0),
        (dt.datetime(2024, 1, 3, 1), dt.datetime(2024, 1, 1, 1), -2),
        (None, dt.datetime(2024, 1, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    assert df.filter(~fn.elapsed_days("a", "b").eqNullSafe(F.col("want"))).count() == 0


def test_capped_keeps_null(spark):
    df = spark.createDataFrame([(None,), (3,), (28,), (29,), (-1,)], "x int")
    assert [r[0] for r in df.select(fn.capped("x", 28)).collect()] == [None, 3, 28, 28, -1]


def test_safe_ln(spark):
    for x, want in [(0.0, 0.0), (-1.0, 0.0), (None, 0.0), (math.e, 1.0)]:
        assert one(spark, fn.safe_ln("x"), x, "double") == want


def test_rounding(spark):
    assert one(spark, fn.half_up("x"), 2.5, "double") == 3
    assert one(spark, fn.half_up("x"), -2.5, "double") == -3
    assert one(spark, fn.half_up("x"), 2.4999999999, "double") == 3
    assert one(spark, fn.half_even("x"), 2.5, "double") == 2


def test_year_after_is_a_range(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").filter(fn.year_after("o_orderdate", 1999))
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert orders.count() == spark.read.parquet(f"{folder}/orders.parquet").filter("year(o_orderdate) > 1999").count()


def test_zero_nonfinite_and_drop_missing(spark):
    rows = [(1.5, 1, "a"), (math.inf, None, None), (-math.inf, 2, "b"), (math.nan, 3, "c"), (None, 4, "d")]
    df = spark.createDataFrame(rows, "x double, k int, s string")
    assert [tuple(r) for r in fn.zero_nonfinite(df).collect()] == [
        (1.5, 1, "a"), (0.0, 0, None), (0.0, 2, "b"), (0.0, 3, "c"), (0.0, 4, "d"),
    ]
    assert fn.drop_missing(df).count() == 2


def test_forecast_id_is_null_with_a_null_part(spark):
    rows = [("a", dt.datetime(2024, 1, 2, 3), 4), ("a", None, 4)]
    df = spark.createDataFrame(rows, "c string, t timestamp_ntz, l int")
    assert [r[0] for r in df.select(fn.forecast_id("c", "t", "l")).collect()] == ["a2024-01-02 03:00:004", None]


def test_flag_and_pattern_filters(spark):
    rows = [(1, None, "Cancel"), (2, False, "cancelled"), (3, False, "xCancely"), (4, True, "Cancel")]
    df = spark.createDataFrame(rows, "i int, f boolean, s string")
    kept = df.filter(~F.col("f") & F.col("s").like("%Cancel%"))
    assert [r["i"] for r in kept.collect()] == [3]
