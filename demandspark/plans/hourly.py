"""Hourly training set."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.scalars import (
    forecast_id,
    hour_features,
    timestamp_lit,
    with_observation_date,
)
from demandspark.operators.curves import cancellation_curve
from demandspark.operators.hourly import (
    hourly_demand_grid,
    slot_rolling_means,
    slot_smoothed_profile,
    smoothed_columns,
    trailing_windows,
)
from demandspark.operators.joins import interval_join, left_join_on

ALPHAS = (0.4, 0.5, 0.6)
PROFILE_COLUMNS = [f"avg_{c}" for c in smoothed_columns(ALPHAS)]


def slot_profile(
    rides: DataFrame, as_of: dt.date | str, after: dt.date | str, pooled: bool = True
) -> DataFrame:
    """Smoothed demand per city, observation date, weekday and hour."""
    grid = hourly_demand_grid(rides, as_of)
    means = slot_rolling_means(grid, as_of, pooled=pooled)
    return slot_smoothed_profile(trailing_windows(means, as_of, after), ALPHAS)


def hourly_training_set(
    past: DataFrame,
    rides: DataFrame,
    as_of: dt.date | str,
    cutoff: dt.date | str,
    cancelled_after: int = 2021,
    pooled: bool = True,
) -> DataFrame:
    """Past hourly forecasts with the slot profile seen on their observation date and the
    cancellations known by then."""
    kept = past.filter(F.col("booked_start_at_local") > timestamp_lit(cutoff))
    dated = hour_features(with_observation_date(kept, "booked_start_at_local"), "booked_start_at_local")
    profiled = left_join_on(
        dated,
        slot_profile(rides, as_of, cutoff, pooled),
        {
            "city_destination": "city_destination",
            "observation_date": "observation_date",
            "delivery_date_dow": "delivery_timestamp_dow",
            "delivery_date_h": "delivery_timestamp_h",
        },
    )
    curve = cancellation_curve(rides, "delivery_timestamp", cancelled_after)
    banded = interval_join(
        profiled,
        curve.withColumnRenamed("delivery_timestamp", "booked_start_at_local"),
        ["city_destination", "booked_start_at_local"],
        "lead_time",
        "next_cancelation_lead_time",
        "cancelation_lead_time",
        ["total_cancelations_rs"],
        strategy="window",  # one forecast and one band per lead of a city's hour
    )
    return banded.select(
        forecast_id("city_destination", "booked_start_at_local", "lead_time").alias("forecast_id"),
        "city_destination",
        "booked_start_at_local",
        "observation_date",
        "delivery_date_weekday",
        "delivery_date_dow",
        "delivery_date_h",
        "lead_time",
        "total_booked_rs",
        "perc_booked_running_sum",
        *PROFILE_COLUMNS,
        "total_cancelations_rs",
        F.col("total_h_demand").alias("target"),
        F.col("forecast_demand").alias("old_forecast"),
    )
