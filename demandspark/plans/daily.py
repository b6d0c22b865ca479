"""Daily training sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.scalars import calendar_features, date_lit, safe_ln
from demandspark.operators.curves import daily_demand, day_curves
from demandspark.operators.joins import left_join_on
from demandspark.operators.smoothing import ema_grid
from demandspark.operators.windows import rolling_means

PREDICTION = "total_booked_cancelation_prediction"
CALENDAR = [f"{d}{p}" for d in ("observation_date", "delivery_date") for p in ("", "_y", "_w", "_d")]

# Smoothing factors by output name, and moving averages by rows before.
FIVE_FACTORS = {f"exp_mov_avg{i}": i / 10 for i in (3, 4, 5, 6, 7)}
THREE_FACTORS = {f"exp_mov_avg{i}": i / 10 for i in (4, 5, 6)}
MOVING_AVERAGES = {f"smoothen_average_pred_{k + 1}": k for k in (2, 6, 13, 20)}


def smoothed_forecasts(
    past: DataFrame, factors: dict[str, float], cutoff: dt.date | str, strategy: str = "window"
) -> DataFrame:
    """Past forecasts after ``cutoff``, smoothed over delivery dates per city and observation
    date. The windows go straight onto the rows, so no self-join is needed.

    A series has one row per lead time, so the key bounds it; a horizon of hundreds of days
    fails with a message and takes ``ranged``."""
    kept = past.filter(F.col("observation_date") > date_lit(cutoff))
    outputs = {name: (PREDICTION, a) for name, a in factors.items()}
    keys = ["city_destination", "observation_date"]
    return ema_grid(kept, outputs, keys, ["delivery_date"], strategy=strategy)


def five_factor_training_set(past: DataFrame, cutoff: dt.date | str, strategy: str = "window") -> DataFrame:
    """Calendar parts, five smoothed predictions and the target."""
    smoothed = smoothed_forecasts(past, FIVE_FACTORS, cutoff, strategy)
    dated = calendar_features(smoothed, ["observation_date", "delivery_date"])
    return dated.select(
        "city_destination", *CALENDAR, "lead_time", *FIVE_FACTORS, PREDICTION, "target_demanded"
    )


def demand_moving_averages(rides: DataFrame, min_year: int = 2022) -> DataFrame:
    """Daily demand with four moving averages along one list ordered by city and date."""
    demand = daily_demand(rides, min_year)
    return rolling_means(
        demand, "total_rides", MOVING_AVERAGES, ["city_destination", "ride_date"]
    )


def full_training_set(
    past: DataFrame,
    rides: DataFrame,
    cutoff: dt.date | str,
    as_of: dt.date | str,
    cancelled_after: int = 2021,
    averages_after: int | None = None,
    strategy: str = "window",
) -> DataFrame:
    """Smoothed predictions, running cancellations, the top booker's amount and logarithms.

    ``averages_after`` also adds the moving averages of demand after that year; they are off
    by default, which saves their join. Both curves come from one scan of the rides, as one row per
    city and day, and a forecast finds its lead in them by position.
    """
    smoothed = smoothed_forecasts(past, THREE_FACTORS, cutoff, strategy)
    curves = day_curves(rides, as_of, cancelled_after).withColumnRenamed("ride_date", "delivery_date")
    joined = smoothed.join(curves, ["city_destination", "delivery_date"], "left")
    # What is known at the next longer lead, as far as the curves go.
    at = F.col("lead_time") + 1
    joined = joined.withColumns(
        {"top_booker_amt": F.get("top_bookings_rs", at), "total_cancelations_rs": F.get("cancelations_rs", at)}
    ).drop("top_bookings_rs", "cancelations_rs")
    extra = []
    if averages_after is not None:
        means = demand_moving_averages(rides, averages_after)
        keys = {"city_destination": "city_destination", "observation_date": F.date_sub("ride_date", 1)}
        joined = left_join_on(joined, means.drop("total_rides"), keys)
        extra = list(MOVING_AVERAGES)
    cancelled = F.coalesce("total_cancelations_rs", F.lit(0))
    dated = calendar_features(joined, ["observation_date", "delivery_date"])
    return dated.select(
        "city_destination",
        *CALENDAR,
        "lead_time",
        *THREE_FACTORS,
        *extra,
        PREDICTION,
        safe_ln(PREDICTION).alias(f"{PREDICTION}_log"),
        safe_ln(cancelled).alias("total_cancelations_rs_log"),
        safe_ln("top_booker_amt").alias("total_bookings_rs_log"),
        "running_sum_bookings",
        cancelled.alias("total_cancelations_rs"),
        "top_booker_amt",
        "target_demanded",
    )
