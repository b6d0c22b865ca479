"""Training sets and curves over the stand-in tables, with the shared dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.params import (
    CANCELLED_AFTER,
    DAILY_AS_OF,
    DAILY_CUTOFF,
    DEMANDED_AFTER,
    HOURLY_AS_OF,
    HOURLY_CUTOFF,
)
from demandspark.operators import curves
from demandspark.plans import daily
from demandspark.plans import hourly as hourly_plans
from demandspark.sources import standins

PRED = "total_booked_cancelation_prediction"


def rounded(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in cols})


def training_full(spark, d, averages: bool = False) -> DataFrame:
    return daily.full_training_set(
        standins.past_forecasts(spark, d),
        standins.rides(spark, d),
        DAILY_CUTOFF,
        DAILY_AS_OF,
        CANCELLED_AFTER,
        DEMANDED_AFTER if averages else None,
    )


def training_hourly(spark, d) -> DataFrame:
    return hourly_plans.hourly_training_set(
        standins.simul_past_forecasts(spark, d),
        standins.simul_rides(spark, d),
        HOURLY_AS_OF,
        HOURLY_CUTOFF,
        CANCELLED_AFTER,
    )


def training_five(spark, d) -> DataFrame:
    return daily.five_factor_training_set(standins.past_forecasts(spark, d), DAILY_CUTOFF)


def curve_daily(spark, d) -> DataFrame:
    return curves.cancellation_curve(standins.rides(spark, d), min_year=CANCELLED_AFTER)


def curve_hourly(spark, d) -> DataFrame:
    return curves.cancellation_curve(
        standins.simul_rides(spark, d), "delivery_timestamp", CANCELLED_AFTER
    )
