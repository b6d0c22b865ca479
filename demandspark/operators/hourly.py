"""Hourly chain: dense grid, slot means, trailing windows, smoothed slot profile."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.scalars import before, date_lit, iso_weekday, whole_div
from demandspark.operators.aggregates import distinct_count_by, mean_by
from demandspark.operators.joins import window_expand
from demandspark.operators.series import first_day, hour_series, with_series
from demandspark.operators.smoothing import ema_grid
from demandspark.operators.windows import block_rolling_means, null_safe_join, ranged_index
from demandspark.sources.scratch import materialize

# Output name -> rows before the current one.
SLOT_WINDOWS = {"rolling_dh_avg2": 2, "rolling_dh_avg4": 4}
WEEKDAY_WINDOWS = {"rolling_d_avg7": 168, "rolling_d_avg14": 336}
HOURS_PER_DAY = 24


def hourly_counts(rides: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Distinct rides per city and hour before ``as_of``, flagged rides out."""
    kept = rides.filter(~F.col("is_emirates") & before("delivery_timestamp", as_of))
    return distinct_count_by(
        kept, ["city_destination", "delivery_timestamp"], "ride_uuid", "total_booked"
    )


def city_hour_grid(rides: DataFrame, as_of: dt.date | str, months: int = 12) -> DataFrame:
    """Every city of the counted rides with every hour of the last months."""
    cities = (
        rides.filter(~F.col("is_emirates") & before("delivery_timestamp", as_of))
        .select("city_destination")
        .distinct()
    )
    return with_series(cities, hour_series(as_of, months), "delivery_timestamp")


def hourly_demand_grid(rides: DataFrame, as_of: dt.date | str, months: int = 12) -> DataFrame:
    """Zero-filled counts on the city-hour grid, with hour and weekday."""
    # One row per city and hour, written once: the cities and their ranks come from it, not from the rides again.
    counts = materialize(hourly_counts(rides, as_of), "hourly-counts")
    cities = counts.select("city_destination").distinct()
    return (
        with_series(cities, hour_series(as_of, months), "delivery_timestamp")
        .join(counts, ["city_destination", "delivery_timestamp"], "left")
        .select(
            "delivery_timestamp",
            "city_destination",
            F.hour("delivery_timestamp").alias("delivery_timestamp_h"),
            iso_weekday("delivery_timestamp").alias("delivery_timestamp_dow"),
            F.coalesce("total_booked", F.lit(0)).alias("total_booked"),
        )
    )


def slot_rolling_means(
    grid: DataFrame, as_of: dt.date | str, months: int = 12, pooled: bool = True
) -> DataFrame:
    """Rolling means inside each weekday-hour slot and each weekday.

    ``pooled`` lets a window run over all cities, ordered by hour and then city; otherwise
    each city has its own. The grid has every city at every hour, so a row's place in its
    pooled slot follows from the hour and the rank of its city, and blocks of places spread
    the few slots over many tasks.
    """
    if not pooled:
        by_slot = ["city_destination", "delivery_timestamp_dow", "delivery_timestamp_h"]
        slot = Window.partitionBy(*by_slot).orderBy("delivery_timestamp")
        day = Window.partitionBy(*by_slot[:2]).orderBy("delivery_timestamp")
        means = {o: F.avg("total_booked").over(slot.rowsBetween(-k, 0)) for o, k in SLOT_WINDOWS.items()}
        means |= {o: F.avg("total_booked").over(day.rowsBetween(-k, 0)) for o, k in WEEKDAY_WINDOWS.items()}
        return grid.withColumns(means)

    cities = ranged_index(grid.select("city_destination").distinct(), ["city_destination"], out="_rank")
    n_cities = cities.count()
    start = first_day(as_of, months)
    day_no = F.datediff(F.to_date("delivery_timestamp"), start)
    week_no = whole_div(day_no, 7)
    placed = (
        null_safe_join(grid, cities, ["city_destination"], "inner")
        .withColumn("_slot_pos", (week_no * n_cities + F.col("_rank")).cast("bigint"))
        .withColumn(
            "_day_pos",
            (
                (week_no * HOURS_PER_DAY + F.col("delivery_timestamp_h")) * n_cities
                + F.col("_rank")
            ).cast("bigint"),
        )
    )
    slots = ["delivery_timestamp_dow", "delivery_timestamp_h"]
    with_slots = block_rolling_means(placed, "total_booked", SLOT_WINDOWS, "_slot_pos", slots)
    with_days = block_rolling_means(
        with_slots, "total_booked", WEEKDAY_WINDOWS, "_day_pos", slots[:1]
    )
    return with_days.drop("_rank", "_slot_pos", "_day_pos")


def trailing_windows(
    grid: DataFrame,
    as_of: dt.date | str,
    after: dt.date | str | None = None,
    days_back: int = 14,
    months: int = 12,
) -> DataFrame:
    """Attach the hours of the trailing days to each observation date and number them by time.

    Observation dates run from ``months`` back (or the day behind ``after``) to ``as_of``. A
    group is one city's hours of ``days_back + 1`` days, at most 24 each. The grid is shuffled by
    city before its hours are copied into the windows, so no copy is shuffled: a city's hours are
    bounded by ``months``, whatever the number of rides.
    """
    lo = first_day(as_of, months)
    if after is not None:
        lo = F.greatest(lo, F.date_add(date_lit(after), 1))
    days = grid.withColumn("_day", F.to_date("delivery_timestamp")).repartition("city_destination")
    spread = window_expand(days, "_day", lo, date_lit(as_of), days_back).drop("_day")
    w = Window.partitionBy("city_destination", "observation_date").orderBy("delivery_timestamp")
    return spread.withColumn("seqnum", F.row_number().over(w).cast("bigint") - 1)


def smoothed_columns(alphas: Sequence[float]) -> dict[str, tuple[str, float]]:
    """Output name -> (rolling mean, factor); the factor's tenths end the name."""
    means = ["rolling_dh_avg4", "rolling_dh_avg2", "rolling_d_avg7", "rolling_d_avg14"]
    return {f"{m}_exp_smooth{round(a * 10)}": (m, a) for m in means for a in alphas}


def slot_smoothed_profile(expanded: DataFrame, alphas: Sequence[float] = (0.4, 0.5, 0.6)) -> DataFrame:
    """Smooth the rolling means over each trailing window, then average by weekday and hour."""
    outputs = smoothed_columns(alphas)
    smoothed = ema_grid(
        expanded,
        outputs,
        ["city_destination", "observation_date"],
        ["seqnum"],
        strategy="window",
    )
    keys = ["city_destination", "observation_date", "delivery_timestamp_dow", "delivery_timestamp_h"]
    return mean_by(smoothed, keys, list(outputs))
