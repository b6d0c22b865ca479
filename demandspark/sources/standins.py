"""Stand-ins for the booking tables, derived from the given star schema and events.

Each function takes the folder of Parquet tables and covers its whole input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORECAST_LEADS = 28
HOURLY_LEADS = 7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rides(spark: SparkSession, folder: str) -> DataFrame:
    """Ride facts: one row per line item, several rows may share a ride."""
    start = "o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT)"
    joined = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, folder, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return joined.select(
        F.col("n_name").alias("city_destination"),
        F.col("o_orderkey").cast("string").alias("ride_uuid"),
        F.expr(start).alias("booked_start_at_local"),
        F.expr(f"{start} - INTERVAL '1' HOUR").alias("booked_start_at"),
        F.expr(
            "o_orderdate - INTERVAL '1' DAY * CAST((o_orderkey * 7) % 40 AS INT) - INTERVAL '3' HOUR"
        ).alias("created_at"),
        F.expr(
            f"CASE WHEN l_returnflag = 'R' THEN {start}"
            " - INTERVAL '1' DAY * CAST(l_partkey % 35 AS INT) - INTERVAL '90' MINUTE END"
        ).alias("canceled_at"),
        F.expr(
            "CASE l_returnflag WHEN 'R' THEN 'CancelledByCustomer'"
            " WHEN 'A' THEN 'Finished' ELSE 'Booked' END"
        ).alias("state"),
        F.expr("CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END").alias(
            "corporation_name"
        ),
        F.expr("r_name = 'MIDDLE EAST'").alias("is_emirates"),
        F.expr("CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END").alias("rides_demanded"),
    )


def simul_rides(spark: SparkSession, folder: str) -> DataFrame:
    """Simulated rides with whole-hour delivery stamps, one row per event."""
    return table(spark, folder, "events").select(
        F.expr("'city_' || CAST(user_id % 8 AS STRING)").alias("city_destination"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("delivery_timestamp"),
        F.col("event_id").cast("string").alias("ride_uuid"),
        F.expr("event_type = 'signup'").alias("is_emirates"),
        F.col("ts").alias("booked_start_at"),
        F.expr(
            "CASE WHEN event_type = 'error' THEN"
            " ts - INTERVAL '1' DAY * CAST(event_id % 35 AS INT) - INTERVAL '90' MINUTE END"
        ).alias("canceled_at"),
        F.expr(
            "CASE event_type WHEN 'error' THEN 'Cancelled' WHEN 'purchase' THEN 'Finished'"
            " ELSE 'Booked' END"
        ).alias("state"),
    )


def past_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """Daily forecasts of the past: 28 lead times for every city and order date."""
    demand = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .groupBy(F.col("n_name").alias("city_destination"), F.to_date("o_orderdate").alias("d"))
        .agg(F.count("*").alias("n"))
    )
    leads = F.explode(F.sequence(F.lit(0), F.lit(FORECAST_LEADS - 1)))
    return demand.withColumn("lead_time", leads).select(
        "city_destination",
        F.date_sub("d", F.col("lead_time")).alias("observation_date"),
        F.col("d").alias("delivery_date"),
        "lead_time",
        F.expr("CAST(n * 10 + (n * 37 + lead_time * 11 + day(d) * 5) % 17 AS DOUBLE)").alias(
            "total_booked_cancelation_prediction"
        ),
        F.expr("CAST(floor(n * 10 * (28 - lead_time) / CAST(28 AS DOUBLE)) AS BIGINT)").alias(
            "running_sum_bookings"
        ),
        F.expr("n * 10 + day(d) % 3").alias("target_demanded"),
    )


def forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Current forecast: the one-day-ahead rows, one per city and ride date."""
    return (
        past_forecasts(spark, folder)
        .filter("lead_time = 1")
        .select(
            "city_destination",
            "observation_date",
            F.col("delivery_date").alias("ride_date"),
            F.col("running_sum_bookings").alias("total_bookings"),
            "total_booked_cancelation_prediction",
        )
    )


def simul_past_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly forecasts of the past: 7 lead times for every city and hour with rides."""
    demand = (
        simul_rides(spark, folder)
        .groupBy("city_destination", "delivery_timestamp")
        .agg(F.count("*").alias("n"))
    )
    leads = F.explode(F.sequence(F.lit(0), F.lit(HOURLY_LEADS - 1)))
    return demand.withColumn("lead_time", leads).select(
        "city_destination",
        F.col("delivery_timestamp").alias("booked_start_at_local"),
        "lead_time",
        F.expr("CAST(floor(n * (7 - lead_time) / CAST(7 AS DOUBLE)) AS BIGINT)").alias(
            "total_booked_rs"
        ),
        F.expr("(7 - lead_time) / CAST(7 AS DOUBLE)").alias("perc_booked_running_sum"),
        F.col("n").alias("total_h_demand"),
        F.expr("CAST(n + (n * 3 + lead_time) % 4 AS DOUBLE)").alias("forecast_demand"),
    )


def polygons(spark: SparkSession, folder: str) -> DataFrame:
    """One closed ring per supplier: six distinct vertices, the first repeated at the end."""
    corner = F.explode(F.sequence(F.lit(0), F.lit(6)))
    return (
        table(spark, folder, "supplier")
        .select(F.col("s_suppkey").alias("polygon_id"), corner.alias("vertex_idx"))
        .selectExpr(
            "polygon_id",
            "vertex_idx",
            "CAST((polygon_id * 7 + (vertex_idx % 6) * (vertex_idx % 6) * 13"
            " + (vertex_idx % 6) * 5) % 101 AS DOUBLE) AS lon",
            "CAST((polygon_id * 11 + (vertex_idx % 6) * 29 + (vertex_idx % 6) * (vertex_idx % 6)"
            " * (vertex_idx % 6) * 3) % 97 AS DOUBLE) AS lat",
        )
    )


def baseline(spark: SparkSession, folder: str) -> DataFrame:
    """Daily order totals, one row per date: stands for the stored baseline."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date_seq"))
        .agg(F.count("*").alias("total_rides"))
    )
