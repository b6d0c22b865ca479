"""Registered queries: name -> (Spark query, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from checks.inputs import (
    PRED,
    curve_daily,
    curve_hourly,
    rounded,
    training_five,
    training_full,
    training_hourly,
)
from checks.models import MODEL_QUERIES
from checks.params import (
    DAILY_AS_OF,
    DAILY_CUTOFF,
    DEMANDED_AFTER,
    HOURLY_AS_OF,
    HOURLY_CUTOFF,
)
from demandspark.functions import scalars as fn
from demandspark.operators import aggregates, curves, geometry, hourly, joins, series, windows
from demandspark.plans import daily, forecasts
from demandspark.plans import hourly as hourly_plans
from demandspark.sources import scratch, standins, tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def add(query: Query) -> Query:
        QUERIES[name] = (query, sql)
        return query

    return add


# ---- sources and sinks ---------------------------------------------------------------------


@register("scan_past_forecasts", O.with_views("SELECT * FROM v_past_forecasts"))
def _(spark, d):
    standins.past_forecasts(spark, d).createOrReplaceTempView("past_forecasts")
    return tables.source(spark, "past_forecasts").select("*")


@register("csv_training_set", O.with_views(O.FIVE_SELECT, O.FIVE_CTES))
def _(spark, d):
    written = training_five(spark, d)
    path = scratch.scratch_path(spark, "training-csv")
    written.write.option("header", True).csv(path)
    return tables.read_training_csv(spark, path, written.schema)


def stored_baseline(spark, d) -> str:
    path = scratch.scratch_path(spark, "baseline-orc")
    standins.baseline(spark, d).write.orc(path)
    return path


@register("orc_baseline_sorted", O.with_views("SELECT * FROM v_baseline ORDER BY date_seq DESC"))
def _(spark, d):
    stored = tables.read_orc(spark, stored_baseline(spark, d))
    return stored.orderBy(F.col("date_seq").desc_nulls_last())


@register("latest_baseline", O.with_views("SELECT * FROM v_baseline ORDER BY date_seq DESC LIMIT 5"))
def _(spark, d):
    return forecasts.latest_baseline(spark, stored_baseline(spark, d))


@register("sql_on_frame", O.with_views(
    "SELECT city_destination, max(total_bookings) AS most FROM v_forecast GROUP BY 1"))
def _(spark, d):
    query = "SELECT city_destination, max(total_bookings) AS most FROM frame GROUP BY 1"
    return tables.sql_on(standins.forecast(spark, d), query)


@register("top_baseline_days", O.with_views("SELECT * FROM v_baseline ORDER BY date_seq DESC LIMIT 5"))
def _(spark, d):
    return aggregates.top_k(standins.baseline(spark, d), "date_seq", 5)


@register("stored_training_set", O.with_views(O.FIVE_SELECT, O.FIVE_CTES))
def _(spark, d):
    path = scratch.scratch_path(spark, "training-set")
    training = training_five(spark, d)
    tables.write_training_set(training, path)
    return tables.read_training_set(spark, path, training.schema)


# ---- series --------------------------------------------------------------------------------


@register("city_hour_grid", O.with_views(
    "SELECT * FROM city_hours", {k: O.GRID_CTES[k] for k in ("hour_counts", "city_hours")}))
def _(spark, d):
    grid = hourly.city_hour_grid(standins.simul_rides(spark, d), HOURLY_AS_OF)
    return grid.select("city_destination", "delivery_timestamp")


@register("city_day_series", O.with_views(f"""
SELECT city_destination, CAST(t.day AS DATE) AS observation_date
FROM (SELECT DISTINCT city_destination FROM v_simul_rides) c CROSS JOIN (
  SELECT unnest(generate_series(CAST(DATE '{HOURLY_AS_OF}' - INTERVAL '12' MONTH AS TIMESTAMP),
   TIMESTAMP '{HOURLY_AS_OF} 00:00:00', INTERVAL '1' DAY)) AS day) t"""))
def _(spark, d):
    cities = aggregates.distinct_values(standins.simul_rides(spark, d), "city_destination")
    return series.with_series(cities, series.day_series(HOURLY_AS_OF), "observation_date")


@register("demand_by_lead_series", O.with_views(
    "SELECT d.*, CAST(l.lead_time AS INT) AS lead_time FROM demand d CROSS JOIN range(29) AS l(lead_time)",
    {"demand": O.DEMAND}))
def _(spark, d):
    demand = curves.daily_demand(standins.rides(spark, d), DEMANDED_AFTER)
    return series.with_series(demand, series.series(0, 28), "lead_time")


# ---- projections, filters, missing values --------------------------------------------------


@register("renamed_forecast", O.with_views(f"""
SELECT city_destination AS city, ride_date AS day, total_bookings AS total_booking, {PRED} AS pred_rides
FROM v_forecast"""))
def _(spark, d):
    return standins.forecast(spark, d).select(
        F.col("city_destination").alias("city"),
        F.col("ride_date").alias("day"),
        F.col("total_bookings").alias("total_booking"),
        F.col(PRED).alias("pred_rides"),
    )


@register("extended_forecast", O.with_views(f"SELECT *, {PRED} - total_bookings AS open_bookings FROM v_forecast"))
def _(spark, d):
    return standins.forecast(spark, d).withColumn("open_bookings", F.col(PRED) - F.col("total_bookings"))


@register("cancelled_rides", O.with_views("""
SELECT city_destination, ride_uuid, booked_start_at, canceled_at, state FROM v_rides
WHERE state LIKE '%Cancel%' AND NOT is_emirates AND year(booked_start_at) > 1997"""))
def _(spark, d):
    return standins.rides(spark, d).filter(
        F.col("state").like("%Cancel%") & ~F.col("is_emirates") & fn.year_after("booked_start_at", 1997)
    ).select("city_destination", "ride_uuid", "booked_start_at", "canceled_at", "state")


@register("demanded_rides_before", O.with_views("""
SELECT city_destination, ride_uuid, booked_start_at_local FROM v_rides
WHERE rides_demanded = 1 AND booked_start_at_local < TIMESTAMP '2000-03-05 00:00:00'"""))
def _(spark, d):
    return standins.rides(spark, d).filter(
        (F.col("rides_demanded") == 1) & fn.before("booked_start_at_local", "2000-03-05")
    ).select("city_destination", "ride_uuid", "booked_start_at_local")


@register("forecasts_between_dates", O.with_views("""
SELECT city_destination, observation_date, delivery_date, target_demanded FROM v_past_forecasts
WHERE delivery_date BETWEEN observation_date + INTERVAL '3' DAY AND observation_date + INTERVAL '14' DAY"""))
def _(spark, d):
    return standins.past_forecasts(spark, d).filter(
        F.col("delivery_date").between(F.date_add("observation_date", 3), F.date_add("observation_date", 14))
    ).select("city_destination", "observation_date", "delivery_date", "target_demanded")


@register("dropped_columns", O.with_views(
    "SELECT city_destination, lead_time, running_sum_bookings, target_demanded FROM v_past_forecasts"))
def _(spark, d):
    return standins.past_forecasts(spark, d).drop("observation_date", "delivery_date", PRED)


@register("complete_rides", O.with_views("""
SELECT ride_uuid, corporation_name, canceled_at FROM v_rides
WHERE corporation_name IS NOT NULL AND canceled_at IS NOT NULL AND ride_uuid IS NOT NULL"""))
def _(spark, d):
    kept = standins.rides(spark, d).select("ride_uuid", "corporation_name", "canceled_at")
    return fn.drop_missing(kept)


_RATIO = (
    f"CASE WHEN lead_time = 26 THEN CAST('NaN' AS DOUBLE) WHEN lead_time = 25 THEN NULL"
    f" WHEN running_sum_bookings = 0 THEN CAST('Infinity' AS DOUBLE)"
    f" ELSE {PRED} / running_sum_bookings END"
)


@register("finite_ratios", O.with_views(f"""
SELECT city_destination, delivery_date, lead_time,
 CASE WHEN r IS NULL OR isnan(r) OR isinf(r) THEN 0.0 ELSE r END AS ratio
FROM (SELECT *, {_RATIO} AS r FROM v_past_forecasts) t"""))
def _(spark, d):
    ratios = standins.past_forecasts(spark, d).withColumn("ratio", F.expr(_RATIO))
    return fn.zero_nonfinite(ratios, ["ratio"]).select("city_destination", "delivery_date", "lead_time", "ratio")


@register("booker_names", O.with_views("SELECT ride_uuid, COALESCE(corporation_name, 'b2c') AS booker FROM v_rides"))
def _(spark, d):
    return standins.rides(spark, d).select(
        "ride_uuid", F.coalesce("corporation_name", F.lit(curves.NO_COMPANY)).alias("booker")
    )


# ---- scalar features -----------------------------------------------------------------------


@register("calendar_features", O.with_views(f"""
SELECT city_destination, observation_date, delivery_date, {O.calendar_sql('observation_date', 'delivery_date')}
FROM v_past_forecasts"""))
def _(spark, d):
    kept = standins.past_forecasts(spark, d).select("city_destination", "observation_date", "delivery_date")
    return fn.calendar_features(kept, ["observation_date", "delivery_date"])


@register("hour_features", O.with_views("""
SELECT *, CAST(isodow(booked_start_at_local) > 5 AS INT) AS delivery_date_weekday,
 CAST(isodow(booked_start_at_local) AS INT) AS delivery_date_dow,
 CAST(hour(booked_start_at_local) AS INT) AS delivery_date_h FROM v_simul_past_forecasts"""))
def _(spark, d):
    return fn.hour_features(standins.simul_past_forecasts(spark, d), "booked_start_at_local")


@register("ride_lead_times", O.with_views(f"""
SELECT ride_uuid, canceled_at, CAST(date_sub('day', created_at, booked_start_at) AS INT) AS booked_days,
 {O.lead_sql('created_at', 'booked_start_at')} AS lead_time,
 {O.lead_sql('canceled_at', 'booked_start_at')} AS cancelation_lead_time FROM v_rides"""))
def _(spark, d):
    booked = fn.elapsed_days("created_at", "booked_start_at")
    cancelled = fn.elapsed_days("canceled_at", "booked_start_at")
    return standins.rides(spark, d).select(
        "ride_uuid",
        "canceled_at",
        booked.alias("booked_days"),
        fn.capped(booked, 28).alias("lead_time"),
        fn.capped(cancelled, 28).alias("cancelation_lead_time"),
    )


@register("observation_dates", O.with_views("""
SELECT booked_start_at_local, city_destination, lead_time,
 CAST(CAST(booked_start_at_local AS DATE) - INTERVAL '1' DAY * lead_time AS DATE) AS observation_date,
 lead_time AS days_ahead FROM v_simul_past_forecasts"""))
def _(spark, d):
    kept = standins.simul_past_forecasts(spark, d).select("booked_start_at_local", "city_destination", "lead_time")
    dated = fn.with_observation_date(kept, "booked_start_at_local")
    gap = F.datediff(F.to_date("booked_start_at_local"), "observation_date")
    return dated.withColumn("days_ahead", gap)


@register("logarithms", O.with_views(O.rounded(f"""
SELECT city_destination, delivery_date, lead_time, running_sum_bookings,
 {O.safe_ln_sql('running_sum_bookings')} AS safe_log,
 ln(1 + CAST(running_sum_bookings AS DOUBLE)) AS running_sum_bookings_log
FROM v_past_forecasts""", {"safe_log": 9, "running_sum_bookings_log": 9})))
def _(spark, d):
    kept = standins.past_forecasts(spark, d).select(
        "city_destination", "delivery_date", "lead_time", "running_sum_bookings"
    ).withColumn("safe_log", fn.safe_ln("running_sum_bookings"))
    return rounded(
        fn.log1p_features(kept, ["running_sum_bookings"]), ["safe_log", "running_sum_bookings_log"], 9
    )


_WAVES = {"week": ("week", 52), "dow": ("dow", 7), "h": ("hour", 24)}
_WAVE_COLS = [f"{p}_{w}" for p, _ in _WAVES.values() for w in ("sin", "cos")]


@register("seasonal_waves", O.with_views(O.rounded(
    "SELECT event_id, " + ", ".join(
        f"{f}(CAST({src} AS DOUBLE) / {period} * 2 * pi()) AS {p}_{f}"
        for src, (p, period) in (("weekofyear(ts)", ("week", 52)), ("isodow(ts)", ("dow", 7)), ("hour(ts)", ("hour", 24)))
        for f in ("sin", "cos")) + " FROM events", {c: 9 for c in _WAVE_COLS})))
def _(spark, d):
    dated = standins.table(spark, d, "events").select(
        "event_id",
        F.weekofyear("ts").alias("week"),
        fn.iso_weekday("ts").alias("dow"),
        F.hour("ts").alias("h"),
    )
    return rounded(fn.cyclical(dated, _WAVES).drop("week", "dow", "h"), _WAVE_COLS, 9)


@register("rounded_predictions", O.with_views(f"""
SELECT city_destination, delivery_date, lead_time, round(round({PRED} / 4, 6)) AS half_up,
 round_even({PRED} / 4, 0) AS half_even, abs({PRED} / 4 - target_demanded) AS gap FROM v_past_forecasts"""))
def _(spark, d):
    quarter = F.col(PRED) / 4
    return standins.past_forecasts(spark, d).select(
        "city_destination",
        "delivery_date",
        "lead_time",
        fn.half_up(quarter).alias("half_up"),
        fn.half_even(quarter).alias("half_even"),
        F.abs(quarter - F.col("target_demanded")).alias("gap"),
    )


@register("forecast_ids", O.with_views("""
SELECT city_destination || strftime(booked_start_at_local, '%Y-%m-%d %H:%M:%S') || CAST(lead_time AS VARCHAR) AS forecast_id
FROM v_simul_past_forecasts"""))
def _(spark, d):
    return standins.simul_past_forecasts(spark, d).select(
        fn.forecast_id("city_destination", "booked_start_at_local", "lead_time").alias("forecast_id")
    )


# ---- joins ---------------------------------------------------------------------------------


@register("left_lookup", O.with_views("""
SELECT p.city_destination, p.observation_date, p.delivery_date, p.lead_time, f.total_bookings
FROM v_past_forecasts p LEFT JOIN v_forecast f ON f.city_destination = p.city_destination
 AND f.observation_date = p.observation_date AND f.ride_date = p.delivery_date"""))
def _(spark, d):
    right = standins.forecast(spark, d).withColumnRenamed("ride_date", "delivery_date").drop(PRED)
    keys = ["city_destination", "observation_date", "delivery_date"]
    return standins.past_forecasts(spark, d).join(right, keys, "left").select(*keys, "lead_time", "total_bookings")


@register("left_lookup_counts", O.with_views("""
SELECT p.city_destination, p.lead_time, count(*) AS n_rows, count(f.city_destination) AS n_found,
 CAST(sum(f.total_bookings) AS BIGINT) AS total_bookings
FROM v_past_forecasts p LEFT JOIN v_forecast f ON f.city_destination = p.city_destination
 AND f.observation_date = p.observation_date AND f.ride_date = p.delivery_date
GROUP BY p.city_destination, p.lead_time"""))
def _(spark, d):
    right = standins.forecast(spark, d).withColumnRenamed("ride_date", "delivery_date").drop(PRED)
    keys = ["city_destination", "observation_date", "delivery_date"]
    joined = standins.past_forecasts(spark, d).join(right.withColumn("_found", F.lit(1)), keys, "left")
    return joined.groupBy("city_destination", "lead_time").agg(
        F.count("*").alias("n_rows"), F.count("_found").alias("n_found"), F.sum("total_bookings").alias("total_bookings")
    )


@register("computed_key_lookup", O.with_views("""
SELECT p.city_destination, p.observation_date, p.delivery_date, d.ride_date, d.total_rides
FROM v_past_forecasts p LEFT JOIN demand d ON d.city_destination = p.city_destination
 AND CAST(d.ride_date - INTERVAL '1' DAY AS DATE) = p.observation_date""", {"demand": O.DEMAND}))
def _(spark, d):
    past = standins.past_forecasts(spark, d).select("city_destination", "observation_date", "delivery_date")
    demand = curves.daily_demand(standins.rides(spark, d), DEMANDED_AFTER)
    keys = {"city_destination": "city_destination", "observation_date": F.date_sub("ride_date", 1)}
    return joins.left_join_on(past, demand, keys)


@register("daily_cancellations_by_lead", O.with_views("""
SELECT p.city_destination, p.delivery_date, p.lead_time, c.total_cancelations_rs
FROM v_past_forecasts p LEFT JOIN cancel_curve c ON c.city_destination = p.city_destination
 AND c.delivery_date = p.delivery_date AND c.cancelation_lead_time - 1 >= p.lead_time
 AND c.next_cancelation_lead_time - 1 < p.lead_time""", O.DAILY_CURVE))
def _(spark, d):
    past = standins.past_forecasts(spark, d).select("city_destination", "delivery_date", "lead_time")
    return joins.interval_join(
        past, curve_daily(spark, d), ["city_destination", "delivery_date"], "lead_time",
        "next_cancelation_lead_time", "cancelation_lead_time", ["total_cancelations_rs"], offset=1,
    )


@register("hourly_cancellations_by_lead", O.with_views("""
SELECT p.city_destination, p.booked_start_at_local, p.lead_time, c.total_cancelations_rs
FROM v_simul_past_forecasts p LEFT JOIN cancel_curve c ON c.city_destination = p.city_destination
 AND c.delivery_timestamp = p.booked_start_at_local AND c.cancelation_lead_time >= p.lead_time
 AND c.next_cancelation_lead_time < p.lead_time""", O.HOURLY_CURVE))
def _(spark, d):
    past = standins.simul_past_forecasts(spark, d).select("city_destination", "booked_start_at_local", "lead_time")
    curve = curve_hourly(spark, d).withColumnRenamed("delivery_timestamp", "booked_start_at_local")
    return joins.interval_join(
        past, curve, ["city_destination", "booked_start_at_local"], "lead_time",
        "next_cancelation_lead_time", "cancelation_lead_time", ["total_cancelations_rs"],
    )


@register("hourly_demand_grid", O.with_views("SELECT * FROM grid", O.GRID_CTES))
def _(spark, d):
    return hourly.hourly_demand_grid(standins.simul_rides(spark, d), HOURLY_AS_OF)


@register("trailing_windows", O.with_views("SELECT * FROM trailing_rows",
    {**O.GRID_CTES, "trailing_rows": O.TRAILING.format(source="grid")}))
def _(spark, d):
    grid = hourly.hourly_demand_grid(standins.simul_rides(spark, d), HOURLY_AS_OF)
    return hourly.trailing_windows(grid, HOURLY_AS_OF, HOURLY_CUTOFF)


# ---- aggregates ----------------------------------------------------------------------------


@register("daily_demand", O.with_views("SELECT * FROM demand", {"demand": O.DEMAND}))
def _(spark, d):
    return curves.daily_demand(standins.rides(spark, d), DEMANDED_AFTER)


@register("hourly_counts", O.with_views("SELECT * FROM hour_counts", {"hour_counts": O.GRID_CTES["hour_counts"]}))
def _(spark, d):
    return hourly.hourly_counts(standins.simul_rides(spark, d), HOURLY_AS_OF)


@register("mean_by_city_and_lead", O.with_views(f"""
SELECT city_destination, lead_time, AVG({PRED}) AS avg_{PRED}, AVG(target_demanded) AS avg_target_demanded
FROM v_past_forecasts GROUP BY 1, 2"""))
def _(spark, d):
    return aggregates.mean_by(
        standins.past_forecasts(spark, d), ["city_destination", "lead_time"], [PRED, "target_demanded"]
    )


@register("distinct_bookers", O.with_views("""
SELECT DISTINCT city_destination, CAST(booked_start_at_local AS DATE) AS ride_date, corporation_name FROM v_rides"""))
def _(spark, d):
    return standins.rides(spark, d).select(
        "city_destination", F.to_date("booked_start_at_local").alias("ride_date"), "corporation_name"
    ).distinct()


@register("distinct_cities", O.with_views("SELECT DISTINCT city_destination FROM v_past_forecasts"))
def _(spark, d):
    return aggregates.distinct_values(standins.past_forecasts(spark, d), "city_destination")


@register("stacked_scores", O.with_views(f"""
SELECT 'daily' AS source, max({PRED}) AS highest FROM v_past_forecasts
UNION ALL SELECT 'hourly' AS source, max(forecast_demand) AS highest FROM v_simul_past_forecasts"""))
def _(spark, d):
    first = standins.past_forecasts(spark, d).agg(F.max(PRED).alias("highest"))
    second = standins.simul_past_forecasts(spark, d).agg(F.max("forecast_demand").alias("highest"))
    return first.withColumn("source", F.lit("daily")).unionByName(second.withColumn("source", F.lit("hourly")))


# ---- windows -------------------------------------------------------------------------------


@register("numbered_forecasts", O.with_views("""
SELECT city_destination, ride_date, CAST(row_number() OVER (PARTITION BY city_destination ORDER BY ride_date) - 1 AS BIGINT) AS seqnum
FROM v_forecast"""))
def _(spark, d):
    kept = standins.forecast(spark, d).select("city_destination", "ride_date")
    return windows.seq_num(kept, ["city_destination"], ["ride_date"], strategy="ranged")


@register("rolling_mean_per_city", O.with_views(f"""
SELECT city_destination, ride_date, AVG({PRED}) OVER (PARTITION BY city_destination ORDER BY ride_date
  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean5 FROM v_forecast"""))
def _(spark, d):
    kept = standins.forecast(spark, d).select("city_destination", "ride_date", PRED)
    return windows.rolling_mean(kept, PRED, ["ride_date"], 4, ["city_destination"], "mean5").drop(PRED)


@register("demand_moving_averages", O.with_views(
    O.rounded("SELECT * FROM averages", {c: 6 for c in O.MEANS}),
    {"demand": O.DEMAND, "averages": O.DEMAND_AVERAGES}))
def _(spark, d):
    return rounded(daily.demand_moving_averages(standins.rides(spark, d), DEMANDED_AFTER), O.MEANS, 6)


@register("slot_rolling_means", O.with_views("SELECT * FROM slot_means", {**O.GRID_CTES, "slot_means": O.slot_means(True)}))
def _(spark, d):
    grid = hourly.hourly_demand_grid(standins.simul_rides(spark, d), HOURLY_AS_OF)
    return hourly.slot_rolling_means(grid, HOURLY_AS_OF)


@register("slot_rolling_means_per_city", O.with_views("SELECT * FROM slot_means", {**O.GRID_CTES, "slot_means": O.slot_means(False)}))
def _(spark, d):
    grid = hourly.hourly_demand_grid(standins.simul_rides(spark, d), HOURLY_AS_OF)
    return hourly.slot_rolling_means(grid, HOURLY_AS_OF, pooled=False)


@register("running_bookings", O.with_views("SELECT * FROM running_bookings",
    {k: O.BOOKING_CTES[k] for k in ("booking_counts", "booking_curve", "running_bookings")}))
def _(spark, d):
    return curves.running_bookings(curves.booking_curve(standins.rides(spark, d), DAILY_AS_OF))


@register("running_demand", O.with_views("""
SELECT city_destination, ride_date, total_rides, CAST(SUM(total_rides) OVER (PARTITION BY city_destination
  ORDER BY ride_date DESC) AS BIGINT) AS rides_from_here_on FROM demand""", {"demand": O.DEMAND}))
def _(spark, d):
    demand = curves.daily_demand(standins.rides(spark, d), DEMANDED_AFTER)
    return windows.running_sum(demand, "total_rides", ["city_destination"], "ride_date", "rides_from_here_on", "ranged")


@register("previous_lead_edges", O.with_views("""
SELECT city_destination, delivery_date, cancelation_lead_time, next_cancelation_lead_time FROM cancel_curve""",
    O.DAILY_CURVE))
def _(spark, d):
    kept = curve_daily(spark, d).select("city_destination", "delivery_date", "cancelation_lead_time")
    return windows.prev_edge(kept, "cancelation_lead_time", ["city_destination", "delivery_date"])


@register("smoothing_grid", O.with_views(
    "SELECT city_destination, observation_date, delivery_date, " + ", ".join(O.FIVE) + " FROM smoothed", O.FIVE_CTES))
def _(spark, d):
    smoothed = daily.smoothed_forecasts(standins.past_forecasts(spark, d), daily.FIVE_FACTORS, DAILY_CUTOFF)
    return smoothed.select("city_destination", "observation_date", "delivery_date", *daily.FIVE_FACTORS)


@register("smoothing_grid_in_blocks", O.with_views(
    "SELECT city_destination, observation_date, delivery_date, " + ", ".join(O.FIVE) + " FROM smoothed", O.FIVE_CTES))
def _(spark, d):
    smoothed = daily.smoothed_forecasts(
        standins.past_forecasts(spark, d), daily.FIVE_FACTORS, DAILY_CUTOFF, "ranged")
    return smoothed.select("city_destination", "observation_date", "delivery_date", *daily.FIVE_FACTORS)


# ---- curves --------------------------------------------------------------------------------


@register("daily_cancellation_curve", O.with_views("""
SELECT *, CAST(delivery_date - INTERVAL '1' DAY * cancelation_lead_time AS DATE) AS observation_date FROM cancel_curve""",
    O.DAILY_CURVE))
def _(spark, d):
    return fn.with_observation_date(curve_daily(spark, d), "delivery_date", "cancelation_lead_time")


@register("hourly_cancellation_curve", O.with_views("SELECT * FROM cancel_curve", O.HOURLY_CURVE))
def _(spark, d):
    return curve_hourly(spark, d)


@register("booking_counts", O.with_views("SELECT * FROM booking_counts", {"booking_counts": O.BOOKING_CTES["booking_counts"]}))
def _(spark, d):
    return curves.booking_counts(standins.rides(spark, d), DAILY_AS_OF)


@register("booking_curve", O.with_views("SELECT * FROM booking_curve",
    {k: O.BOOKING_CTES[k] for k in ("booking_counts", "booking_curve")}))
def _(spark, d):
    return curves.booking_curve(standins.rides(spark, d), DAILY_AS_OF)


@register("top_booker", O.with_views("SELECT * FROM top_booker", O.BOOKING_CTES))
def _(spark, d):
    return curves.top_booker(curves.booking_curve(standins.rides(spark, d), DAILY_AS_OF))


@register("top_booker_amounts", O.with_views(
    "SELECT city_destination, ride_date, lead_time, total_bookings_rs FROM top_booker", O.BOOKING_CTES))
def _(spark, d):
    amounts = curves.top_booker_amounts(standins.rides(spark, d), DAILY_AS_OF)
    return amounts.select(
        "city_destination", "ride_date", F.posexplode("top_bookings_rs").alias("lead_time", "total_bookings_rs")
    )


@register("slot_smoothed_profile", O.with_views(
    O.rounded("SELECT * FROM profile", {c: 6 for c in O.PROFILE}), O.PROFILE_CTES))
def _(spark, d):
    profile = hourly_plans.slot_profile(standins.simul_rides(spark, d), HOURLY_AS_OF, HOURLY_CUTOFF)
    return rounded(profile, O.PROFILE, 6)


# ---- polygons ------------------------------------------------------------------------------


@register("ring_vertices", O.with_views("SELECT * FROM v_polygons WHERE vertex_idx < 6"))
def _(spark, d):
    return geometry.ring_vertices(standins.polygons(spark, d))


@register("delaunay_triangles", O.with_views("""
SELECT t.polygon_id, t.a, t.b, t.c FROM tri t WHERE NOT EXISTS (
  SELECT 1 FROM v d WHERE d.polygon_id = t.polygon_id AND d.vertex_idx NOT IN (t.a, t.b, t.c) AND (
    circle(t.ax, t.ay, t.bx, t.by, t.cx, t.cy, d.lon, d.lat) * sign(t.turn) > 0
    OR (circle(t.ax, t.ay, t.bx, t.by, t.cx, t.cy, d.lon, d.lat) = 0 AND (d.vertex_idx < t.a
      OR ((t.cx - t.bx) * (d.lat - t.by) - (t.cy - t.by) * (d.lon - t.bx)) * t.turn < 0))))"""
    .replace("circle(t.ax, t.ay, t.bx, t.by, t.cx, t.cy, d.lon, d.lat)", """(
 (t.ax-d.lon) * ((t.by-d.lat) * ((t.cx-d.lon)*(t.cx-d.lon) + (t.cy-d.lat)*(t.cy-d.lat))
   - ((t.bx-d.lon)*(t.bx-d.lon) + (t.by-d.lat)*(t.by-d.lat)) * (t.cy-d.lat))
 - (t.ay-d.lat) * ((t.bx-d.lon) * ((t.cx-d.lon)*(t.cx-d.lon) + (t.cy-d.lat)*(t.cy-d.lat))
   - ((t.bx-d.lon)*(t.bx-d.lon) + (t.by-d.lat)*(t.by-d.lat)) * (t.cx-d.lon))
 + ((t.ax-d.lon)*(t.ax-d.lon) + (t.ay-d.lat)*(t.ay-d.lat)) * ((t.bx-d.lon) * (t.cy-d.lat) - (t.by-d.lat) * (t.cx-d.lon)))"""),
    {"v": "SELECT * FROM v_polygons WHERE vertex_idx < 6",
     "tri": """SELECT * FROM (SELECT a.polygon_id, a.vertex_idx AS a, b.vertex_idx AS b, c.vertex_idx AS c,
       a.lon AS ax, a.lat AS ay, b.lon AS bx, b.lat AS by, c.lon AS cx, c.lat AS cy,
       (b.lon - a.lon) * (c.lat - a.lat) - (b.lat - a.lat) * (c.lon - a.lon) AS turn
      FROM v a JOIN v b ON b.polygon_id = a.polygon_id AND b.vertex_idx > a.vertex_idx
      JOIN v c ON c.polygon_id = a.polygon_id AND c.vertex_idx > b.vertex_idx) t WHERE turn <> 0"""}))
def _(spark, d):
    return geometry.delaunay_triangles(geometry.ring_vertices(standins.polygons(spark, d)))


# ---- end-to-end queries --------------------------------------------------------------------


MOVING_AVERAGE_SQL = O.with_views(O.rounded(f"""
SELECT city_destination AS city, ride_date AS day, total_bookings AS total_booking, {PRED} AS pred_rides,
 AVG({PRED}) OVER (ORDER BY ride_date, city_destination ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
  AS smoothen_average_pred_7 FROM v_forecast""", {"smoothen_average_pred_7": 6}))
SMOOTHING_SQL = O.with_views(
    f"SELECT city_destination, ride_date, total_bookings, {PRED}, {O.ema_sql(PRED, 0.5, 'city_destination')} AS exp_mov_avg FROM n",
    {"n": "SELECT *, row_number() OVER (PARTITION BY city_destination ORDER BY ride_date) - 1 AS seqnum FROM v_forecast"})


@register("moving_average_forecast", MOVING_AVERAGE_SQL)
def _(spark, d):
    return rounded(
        forecasts.moving_average_forecast(standins.forecast(spark, d)), ["smoothen_average_pred_7"], 6
    )


@register("moving_average_in_blocks", MOVING_AVERAGE_SQL)
def _(spark, d):
    averaged = forecasts.moving_average_forecast(standins.forecast(spark, d), block=64)
    return rounded(averaged, ["smoothen_average_pred_7"], 6)


@register("exponential_smoothing_forecast", SMOOTHING_SQL)
def _(spark, d):
    return forecasts.exponential_smoothing_forecast(standins.forecast(spark, d))


@register("smoothing_long_series", SMOOTHING_SQL)
def _(spark, d):
    return forecasts.exponential_smoothing_forecast(standins.forecast(spark, d), strategy="ranged", block=64)


@register("five_factor_training_set", O.with_views(O.FIVE_SELECT, O.FIVE_CTES))
def _(spark, d):
    return training_five(spark, d)


@register("full_training_set", O.with_views(O.rounded(O.full_select(), {c: 9 for c in O.LOGS}), O.FULL_CTES))
def _(spark, d):
    return rounded(training_full(spark, d), O.LOGS, 9)


@register("full_training_set_with_averages", O.with_views(
    O.rounded(O.full_select(
        ", ".join(f"m.{c}" for c in O.MEANS) + ",",
        "LEFT JOIN averages m ON m.city_destination = p.city_destination"
        " AND CAST(m.ride_date - INTERVAL '1' DAY AS DATE) = p.observation_date"),
        {**{c: 9 for c in O.LOGS}, **{c: 6 for c in O.MEANS}}),
    {**O.FULL_CTES, "demand": O.DEMAND, "averages": O.DEMAND_AVERAGES}))
def _(spark, d):
    return rounded(rounded(training_full(spark, d, averages=True), O.LOGS, 9), O.MEANS, 6)


@register("hourly_training_set", O.with_views(
    O.rounded(O.HOURLY_SELECT, {**{c: 6 for c in O.PROFILE}, "perc_booked_running_sum": 9}), O.HOURLY_CTES))
def _(spark, d):
    return rounded(rounded(training_hourly(spark, d), O.PROFILE, 6), ["perc_booked_running_sum"], 9)


QUERIES.update(MODEL_QUERIES)
