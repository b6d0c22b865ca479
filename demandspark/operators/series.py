"""Integer, hour and day series, attached to the rows of a table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.scalars import date_lit


def series(lo: int, hi: int, step: int = 1) -> Column:
    """Array of the integers from ``lo`` to ``hi``, both included."""
    return F.sequence(F.lit(lo), F.lit(hi), F.lit(step))


def first_day(as_of: dt.date | str, months: int = 12) -> Column:
    """The day ``months`` before ``as_of``; a month end is clamped."""
    return F.add_months(date_lit(as_of), -months)


def hour_series(as_of: dt.date | str, months: int = 12) -> Column:
    """Array of hour stamps from ``months`` back up to midnight of ``as_of``, both included."""
    start = first_day(as_of, months).cast("timestamp_ntz")
    return F.sequence(start, date_lit(as_of).cast("timestamp_ntz"), F.expr("INTERVAL '1' HOUR"))


def day_series(as_of: dt.date | str, months: int = 12) -> Column:
    """Array of days from ``months`` back up to ``as_of``, both included."""
    return F.sequence(first_day(as_of, months), date_lit(as_of))


def with_series(df: DataFrame, values: Column, out: str) -> DataFrame:
    """Repeat each row for every element of an array; needs no join and no shuffle."""
    return df.withColumn(out, F.explode(values))
