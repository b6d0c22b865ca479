import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandspark.operators import curves, hourly, series
from demandspark.operators.joins import interval_join, left_join_on, window_expand
from demandspark.operators.windows import with_halo
from demandspark.sources import standins

D = dt.date


def ride(uuid, city="x", start=dt.datetime(2024, 5, 10, 9), lead=1, cancel=None, state="Booked", company="acme", flag=False):
    return (
        city, uuid, start, start,
        None if lead is None else start - dt.timedelta(days=lead),
        None if cancel is None else start - dt.timedelta(days=cancel),
        state, company, flag, 1,
    )


SCHEMA = (
    "city_destination string, ride_uuid string, booked_start_at_local timestamp_ntz,"
    " booked_start_at timestamp_ntz, created_at timestamp_ntz, canceled_at timestamp_ntz,"
    " state string, corporation_name string, is_emirates boolean, rides_demanded int"
)


def test_interval_join_edges(spark):
    bands = spark.createDataFrame([("a", -1, 2, 10), ("a", 2, 5, 20)], "k string, lo int, hi int, v int")
    points = spark.createDataFrame(
        [("a", p) for p in (-2, -1, 0, 2, 3, 5, 6)] + [("b", 1), (None, 1)], "k string, p int")
    got = interval_join(points, bands, ["k"], "p", "lo", "hi", ["v"])
    assert {(r["k"], r["p"]): r["v"] for r in got.collect()} == {
        ("a", -2): None, ("a", -1): None, ("a", 0): 10, ("a", 2): 10, ("a", 3): 20, ("a", 5): 20,
        ("a", 6): None, ("b", 1): None, (None, 1): None,
    }
    shifted = interval_join(points, bands, ["k"], "p", "lo", "hi", ["v"], offset=1)
    assert {r["p"]: r["v"] for r in shifted.filter("k = 'a'").collect()} == {
        -2: None, -1: 10, 0: 10, 2: 20, 3: 20, 5: None, 6: None}


def test_bands_of_a_hot_key_reach_across_slices(spark):
    """One key holds most points and one band of another covers many slices; rows repeat and keys are NULL."""
    key = "if(id % 3 > 0, 'hot', if(id % 9 = 0, null, concat('k', id % 5)))"
    points = spark.range(9000).selectExpr(f"{key} as k", "int(id * 7919 % 5000) as p", "id % 2 as hi").unionAll(
        spark.range(3).selectExpr("'hot' as k", "cast(null as int) as p", "1L as hi"))
    bands = spark.range(0, 5000, 1250).selectExpr("'hot' as k", "int(id) as lo", "int(id + 1000) as up", "id as v").unionAll(
        spark.createDataFrame([("k1", -1, 4999, 7), ("k2", 10, 10, 8), (None, 0, 9999, 9)], "k string, lo int, up int, v long"))
    held = [tuple(r) for r in bands.collect()]
    want = []
    for k, p, hi in points.collect():
        found = [v for b, lo, up, v in held if None not in (k, p) and b == k and lo < p <= up]
        want.append((k, p, hi, found[0] if found else None))
    for strategy in ("ranged", "window"):
        got = interval_join(points, bands, ["k"], "p", "lo", "up", ["v"], strategy=strategy)
        assert got.columns == ["k", "p", "hi", "v"]
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    plan = interval_join(points, bands, ["k"], "p", "lo", "up", ["v"])._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("<" in line.split("BuildRight")[-1] or ">" in line.split("BuildRight")[-1] for line in joins)
    assert interval_join(points.where("false"), bands, ["k"], "p", "lo", "up", ["v"]).count() == 0
    assert interval_join(points, bands.where("false"), ["k"], "p", "lo", "up", ["v"]).where("v is not null").count() == 0


def test_window_expand_equals_range_join(spark):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    rows = spark.createDataFrame([(d,) for d in days], "d date")
    lo, hi = D(2024, 1, 10), D(2024, 1, 25)
    got = sorted(tuple(r) for r in window_expand(rows, "d", lo, hi, 4).collect())
    want = sorted(
        (d, o) for d in days for o in days if lo <= o <= hi and o - dt.timedelta(days=4) <= d <= o)
    assert got == want


def test_left_join_on_keeps_unmatched(spark):
    left = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 1))], "k string, d date")
    right = spark.createDataFrame([("a", D(2024, 1, 2), 7)], "k string, e date, v int")
    got = left_join_on(left, right, {"k": "k", "d": F.date_sub("e", 1)})
    assert {(r["k"], r["v"]) for r in got.collect()} == {("a", 7), ("b", None)}


def test_cancellation_bands_tile_the_leads(spark, folder):
    curve = curves.cancellation_curve(standins.rides(spark, folder), min_year=1990)
    keys = ["city_destination", "delivery_date"]
    points = curve.select(*keys).distinct().withColumn("p", F.explode(F.sequence(F.lit(-3), F.lit(30))))
    found = interval_join(points, curve, keys, "p", "next_cancelation_lead_time", "cancelation_lead_time", ["total_cancelations_rs"])
    assert found.count() == points.count()


def test_cancellation_curve_cases(spark):
    rows = [
        ride("1", cancel=3, state="Cancelled"),
        ride("1", cancel=3, state="Cancelled"),
        ride("2", cancel=40, state="xCancelx"),
        ride("3", cancel=1, state="cancelled"),
        ride("4", cancel=1, state="Cancelled", flag=None),
        ride("5", cancel=-2, state="Cancelled"),
        ride("6", cancel=None, state="Cancelled"),
    ]
    got = curves.cancellation_curve(spark.createDataFrame(rows, SCHEMA))
    assert {(r[2], r[3], r[4], r[5]) for r in got.collect()} == {
        (28, 1, 1, 3), (3, 1, 2, -2), (-2, 1, 3, -1), (None, 1, 4, 28)}


def test_booking_curve_is_dense(spark):
    rows = [
        ride("1", lead=0), ride("2", lead=28), ride("3", lead=99), ride("4", lead=-1, company="late"),
        ride("5", lead=None, company=None), ride("6", lead=2, company=None), ride("6", lead=2, company=None),
        ride("7", lead=2, flag=True, company="hidden"), (*ride("8")[:1], None, *ride("8")[2:]),
    ]
    rides = spark.createDataFrame(rows, SCHEMA)
    curve = curves.booking_curve(rides, "2024-06-01")
    per_booker = {r["booker"]: r["n"] for r in curve.groupBy("booker").agg(F.count("*").alias("n")).collect()}
    assert per_booker == {"acme": 29, "late": 29, "b2c": 29}
    filled = {(r["booker"], r["lead_time"]): r["total_bookings"] for r in curve.filter("total_bookings > 0").collect()}
    assert filled == {("acme", 0): 1, ("acme", 28): 2, ("b2c", 2): 1}
    top = {r["lead_time"]: (r["booker"], r["total_bookings_rs"]) for r in curves.top_booker(curve).collect()}
    assert top[0] == ("acme", 3) and top[28] == ("acme", 2) and len(top) == 29
    amounts = curves.top_booker_amounts(rides, "2024-06-01").first()["top_bookings_rs"]
    assert amounts == [top[k][1] for k in range(29)]


def test_top_booker_tie_goes_to_first_name(spark):
    rows = [ride("1", lead=5, company="zeta"), ride("2", lead=5, company="beta")]
    curve = curves.booking_curve(spark.createDataFrame(rows, SCHEMA), "2024-06-01")
    assert {r["booker"] for r in curves.top_booker(curve).collect()} == {"beta"}


def test_smoothing_key_is_unique_in_the_stand_in(spark, folder):
    past = standins.past_forecasts(spark, folder)
    keys = ["city_destination", "observation_date", "delivery_date"]
    assert past.groupBy(*keys).count().filter("count > 1").count() == 0


def test_series_ends_are_included(spark):
    one = spark.createDataFrame([(1,)], "x int")
    assert series.with_series(one, series.day_series("2024-02-29", 12), "d").agg(F.min("d"), F.count("*")).first()[:] == (D(2023, 2, 28), 367)
    hours = series.with_series(one, series.hour_series("2024-01-31", 1), "h")
    assert hours.agg(F.max("h"), F.count("*")).first()[:] == (dt.datetime(2024, 1, 31), 31 * 24 + 1)


def test_pooled_slot_means_equal_plain_window(spark, folder):
    from pyspark.sql import Window

    grid = hourly.hourly_demand_grid(standins.simul_rides(spark, folder), "2024-01-31")
    got = hourly.slot_rolling_means(grid, "2024-01-31")
    slot = Window.partitionBy("delivery_timestamp_dow", "delivery_timestamp_h").orderBy("delivery_timestamp", "city_destination")
    day = Window.partitionBy("delivery_timestamp_dow").orderBy("delivery_timestamp", "city_destination")
    plain = grid.withColumns(
        {o: F.avg("total_booked").over(slot.rowsBetween(-k, 0)) for o, k in hourly.SLOT_WINDOWS.items()}
        | {o: F.avg("total_booked").over(day.rowsBetween(-k, 0)) for o, k in hourly.WEEKDAY_WINDOWS.items()})
    assert got.count() == plain.count()
    assert got.select(*plain.columns).exceptAll(plain).count() == 0


def test_halo_must_fit_the_block(spark):
    with pytest.raises(ValueError):
        with_halo(spark.range(3), "id", 5, 2)
