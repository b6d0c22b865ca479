"""Booking and cancellation curves over the lead time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.scalars import before, capped, elapsed_days, year_after
from demandspark.operators.aggregates import distinct_count_by
from demandspark.operators.windows import (
    ascending,
    prev_edge,
    running_sum,
    top_per_group,
)

LEAD_CAP = 28
NO_COMPANY = "b2c"


def daily_demand(rides: DataFrame, min_year: int = 2022) -> DataFrame:
    """Distinct demanded rides per city and local day, after ``min_year``, flagged rides out."""
    kept = rides.filter(
        (F.col("rides_demanded") == 1)
        & year_after("booked_start_at_local", min_year)
        & ~F.col("is_emirates")
    ).withColumn("ride_date", F.to_date("booked_start_at_local"))
    return distinct_count_by(kept, ["city_destination", "ride_date"], "ride_uuid", "total_rides")


def cancellation_curve(
    rides: DataFrame,
    delivery: str = "delivery_date",
    min_year: int = 2021,
    cap: int = LEAD_CAP,
) -> DataFrame:
    """Cancelled rides by lead, their running total from the longest lead down, and band edges.

    ``delivery`` names the key the curve is built for: ``delivery_date`` is the local day of
    the ride; any other name is taken as a column of ``rides``. After the distinct count a
    group has one row per different lead, so its windows stay small whatever the city's size.
    """
    if delivery == "delivery_date":
        rides = rides.withColumn(delivery, F.to_date("booked_start_at_local"))
    keys = ["city_destination", delivery]
    cancelled = rides.filter(
        F.col("state").like("%Cancel%")
        & ~F.col("is_emirates")
        & year_after("booked_start_at", min_year)
    ).withColumn(
        "cancelation_lead_time", capped(elapsed_days("canceled_at", "booked_start_at"), cap)
    )
    counts = distinct_count_by(
        cancelled, [*keys, "cancelation_lead_time"], "ride_uuid", "total_cancelations"
    )
    curve = running_sum(
        counts,
        "total_cancelations",
        keys,
        "cancelation_lead_time",
        "total_cancelations_rs",
        strategy="window",
    )
    return prev_edge(curve, "cancelation_lead_time", keys, -1, strategy="window")


def _booked_rides(rides: DataFrame, as_of: dt.date | str, cap: int) -> DataFrame:
    """Different (city, day, booker, lead, ride) of the rides before ``as_of``."""
    return (
        rides.filter(before("booked_start_at_local", as_of) & ~F.col("is_emirates"))
        .select(
            "city_destination",
            F.to_date("booked_start_at_local").alias("ride_date"),
            F.coalesce("corporation_name", F.lit(NO_COMPANY)).alias("booker"),
            capped(elapsed_days("created_at", "booked_start_at"), cap).alias("lead_time"),
            "ride_uuid",
        )
        .distinct()
    )


def booking_counts(rides: DataFrame, as_of: dt.date | str, cap: int = LEAD_CAP) -> DataFrame:
    """Distinct bookings per city, day, capped lead and booker, as they occur."""
    kept = rides.filter(before("booked_start_at_local", as_of) & ~F.col("is_emirates")).select(
        "city_destination",
        F.to_date("booked_start_at_local").alias("ride_date"),
        capped(elapsed_days("created_at", "booked_start_at"), cap).alias("lead_time"),
        F.coalesce("corporation_name", F.lit(NO_COMPANY)).alias("booker"),
        "ride_uuid",
    )
    keys = ["city_destination", "ride_date", "lead_time", "booker"]
    return distinct_count_by(kept, keys, "ride_uuid", "total_bookings")


def booking_curve(rides: DataFrame, as_of: dt.date | str, cap: int = LEAD_CAP) -> DataFrame:
    """Booking counts with a row for every lead 0..cap; leads below 0 drop out.

    One aggregation fills a counter per lead, so neither a series join nor a self-join is
    needed to find the gaps.
    """
    keys = ["city_destination", "ride_date", "booker"]
    known = F.col("ride_uuid").isNotNull()
    dense = _booked_rides(rides, as_of, cap).groupBy(*keys).agg(
        *[F.count_if((F.col("lead_time") == k) & known).alias(f"_{k}") for k in range(cap + 1)]
    )
    filled = F.posexplode(F.array(*[F.col(f"_{k}") for k in range(cap + 1)]))
    return dense.select(*keys, filled.alias("lead_time", "total_bookings")).select(
        "city_destination", "ride_date", "lead_time", "booker", "total_bookings"
    )


def running_bookings(curve: DataFrame) -> DataFrame:
    """Running bookings from the longest lead down, per city, day and booker."""
    keys = ["city_destination", "ride_date", "booker"]
    return running_sum(
        curve, "total_bookings", keys, "lead_time", "total_bookings_rs", strategy="window"
    )


def top_booker(curve: DataFrame) -> DataFrame:
    """Booker with most running bookings per city, day and lead; ties go to the first name."""
    order = [F.col("total_bookings_rs").desc_nulls_last(), *ascending(["booker"])]
    return top_per_group(
        running_bookings(curve), ["city_destination", "ride_date", "lead_time"], order
    )


def top_booker_amounts(
    rides: DataFrame, as_of: dt.date | str, cap: int = LEAD_CAP
) -> DataFrame:
    """Running bookings of the top booker per city and day, as an array indexed by lead.

    Equal to ``top_booker(booking_curve(...))`` without the booker's name: counting the rides
    with a lead of at least k gives the running total at once, and the top amount is a maximum.
    """
    days = ["city_destination", "ride_date"]
    leads = range(cap + 1)
    known = F.col("ride_uuid").isNotNull()
    totals = _booked_rides(rides, as_of, cap).groupBy(*days, "booker").agg(
        *[F.count_if((F.col("lead_time") >= k) & known).alias(f"_{k}") for k in leads]
    )
    best = totals.groupBy(*days).agg(*[F.max(f"_{k}").alias(f"_{k}") for k in leads])
    return best.select(*days, F.array(*[F.col(f"_{k}") for k in leads]).alias("top_bookings_rs"))


def day_curves(
    rides: DataFrame, as_of: dt.date | str, min_year: int = 2021, cap: int = LEAD_CAP
) -> DataFrame:
    """Running cancellations and the top booker's running bookings per city and day, as arrays
    indexed by lead, from one scan of the rides.

    A ride counts once as booked and once as cancelled; what tells them apart is the booker, NULL
    on a cancellation. ``cancelations_rs`` at k holds the cancellations with a lead of at least k,
    which is the running total of the band of ``cancellation_curve`` that k lies in;
    ``top_bookings_rs`` is that of ``top_booker_amounts``. A day without either has NULL entries
    for it. Leads below 0 have no entry.
    """
    days, leads = ["city_destination", "ride_date"], range(cap + 1)
    booked = before("booked_start_at_local", as_of)
    cancelled = F.col("state").like("%Cancel%") & year_after("booked_start_at", min_year)

    def entry(kept: Column, booker: Column, since: str) -> Column:
        lead = capped(elapsed_days(since, "booked_start_at"), cap)
        return F.when(kept, F.struct(booker.alias("booker"), lead.alias("lead_time")))

    company = F.coalesce("corporation_name", F.lit(NO_COMPANY))
    entries = F.array(
        entry(booked, company, "created_at"), entry(cancelled, F.lit(None).cast("string"), "canceled_at")
    )
    counted = (
        rides.filter(~F.col("is_emirates") & (booked | cancelled) & F.col("ride_uuid").isNotNull())
        .select(
            "city_destination",
            F.to_date("booked_start_at_local").alias("ride_date"),
            F.explode(F.array_compact(entries)).alias("_entry"),
            "ride_uuid",
        )
        .select(*days, "_entry.booker", "_entry.lead_time", "ride_uuid")
        .distinct()
    )
    totals = counted.groupBy(*days, "booker").agg(
        *[F.count_if(F.col("lead_time") >= k).alias(f"_{k}") for k in leads]
    )
    of_day = {"top_bookings_rs": F.col("booker").isNotNull(), "cancelations_rs": F.col("booker").isNull()}
    best = totals.groupBy(*days).agg(
        *[F.max(F.when(kept, F.col(f"_{k}"))).alias(f"{name}_{k}") for name, kept in of_day.items() for k in leads]
    )
    return best.select(*days, *[F.array(*[F.col(f"{name}_{k}") for k in leads]).alias(name) for name in of_day])
