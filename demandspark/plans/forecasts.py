"""Smoothed views of the current forecast and the latest stored baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.operators.smoothing import ema
from demandspark.operators.windows import BLOCK_ROWS, rolling_mean
from demandspark.sources.tables import read_orc, sql_on

PREDICTION = "total_booked_cancelation_prediction"


def moving_average_forecast(forecast: DataFrame, per_city: bool = False, block: int = BLOCK_ROWS) -> DataFrame:
    """Forecast with the mean of the current and six earlier rows, sorted for reading.

    The series runs over all cities in date order (city breaks ties); ``per_city`` gives each
    city its own. ``block`` is the number of rows of a block of the series.
    """
    averaged = rolling_mean(
        forecast,
        PREDICTION,
        ["ride_date"] if per_city else ["ride_date", "city_destination"],
        preceding=6,
        partition_by=["city_destination"] if per_city else [],
        out="smoothen_average_pred_7",
        block=block,
    )
    return averaged.select(
        F.col("city_destination").alias("city"),
        F.col("ride_date").alias("day"),
        F.col("total_bookings").alias("total_booking"),
        F.col(PREDICTION).alias("pred_rides"),
        "smoothen_average_pred_7",
    ).orderBy("city", F.col("day").desc())


def exponential_smoothing_forecast(
    forecast: DataFrame, alpha: float = 0.5, strategy: str = "ranged", block: int | None = None
) -> DataFrame:
    """Forecast smoothed per city in date order."""
    columns = ["city_destination", "ride_date", "total_bookings", PREDICTION]
    return ema(
        forecast.select(*columns), PREDICTION, alpha, ["city_destination"], ["ride_date"], strategy=strategy, block=block
    )


def latest_baseline(spark, path: str, rows: int = 5) -> DataFrame:
    """The last dates of a baseline stored as ORC."""
    query = f"SELECT * FROM frame ORDER BY date_seq DESC NULLS LAST LIMIT {int(rows)}"
    return sql_on(read_orc(spark, path), query)
