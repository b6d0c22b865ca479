"""Column expressions; all stay on the JVM side."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def timestamp_lit(value: dt.date | str) -> Column:
    """Wall-clock literal; a date means its midnight."""
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def whole_div(col: Column | str, by: int) -> Column:
    """Integer quotient, exact for any bigint."""
    return F.call_function("div", as_column(col), F.lit(by))


def iso_weekday(col: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(as_column(col)) + 1


def year_after(col: Column | str, year: int) -> Column:
    """``year(col) > year`` written as a range, so that file statistics can skip data."""
    return as_column(col) >= timestamp_lit(f"{year + 1:04d}-01-01")


def before(col: Column | str, as_of: dt.date | str) -> Column:
    """``col`` lies before the start of the day ``as_of``."""
    return as_column(col) < timestamp_lit(as_of)


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end``, cut toward zero; 23:00 to 01:00 counts 0."""
    gap = as_column(end).cast("timestamp_ntz") - as_column(start).cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), gap).cast("int")


def capped(col: Column | str, cap: int) -> Column:
    """``least(cap, col)`` that keeps NULL (the built-in skips it)."""
    c = as_column(col)
    return F.when(c.isNotNull(), F.least(F.lit(cap), c))


def safe_ln(col: Column | str) -> Column:
    """Natural logarithm, 0 where it is undefined."""
    c = as_column(col).cast("double")
    return F.when(c > 0, F.ln(c)).otherwise(F.lit(0.0))


def half_up(col: Column | str) -> Column:
    """Round to an integer, halves away from zero; the inner step removes binary noise."""
    return F.round(F.round(as_column(col), 6))


def half_even(col: Column | str) -> Column:
    """Round to an integer, halves to the even neighbour."""
    return F.rint(as_column(col))


def season_sin(col: Column | str, period: float) -> Column:
    return F.sin(as_column(col) / F.lit(float(period)) * F.lit(2 * math.pi))


def season_cos(col: Column | str, period: float) -> Column:
    return F.cos(as_column(col) / F.lit(float(period)) * F.lit(2 * math.pi))


def calendar_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """Add year, ISO week and ISO weekday of each date as ``<col>_y``, ``_w``, ``_d``."""
    parts = {}
    for c in cols:
        parts[f"{c}_y"] = F.year(c)
        parts[f"{c}_w"] = F.weekofyear(c)
        parts[f"{c}_d"] = iso_weekday(c)
    return df.withColumns(parts)


def hour_features(df: DataFrame, ts: str, prefix: str = "delivery_date") -> DataFrame:
    """Add weekend flag (named ``_weekday``, 1 on Saturday and Sunday), weekday and hour."""
    return df.withColumns(
        {
            f"{prefix}_weekday": (iso_weekday(ts) > 5).cast("int"),
            f"{prefix}_dow": iso_weekday(ts),
            f"{prefix}_h": F.hour(ts),
        }
    )


def with_observation_date(
    df: DataFrame, delivery: str, lead: str = "lead_time", out: str = "observation_date"
) -> DataFrame:
    """Date on which a row was observed: its delivery day minus its lead in days."""
    return df.withColumn(out, F.date_sub(F.to_date(delivery), F.col(lead)))


def forecast_id(city: str, ts: str, lead: str) -> Column:
    """Row identifier; NULL when a part is NULL."""
    stamp = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return F.concat(F.col(city), stamp, F.col(lead).cast("string"))


def cyclical(df: DataFrame, periods: dict[str, tuple[str, float]]) -> DataFrame:
    """Sine and cosine of ``{column: (prefix, period)}`` as ``<prefix>_sin``, ``<prefix>_cos``."""
    waves = {}
    for c, (prefix, period) in periods.items():
        waves[f"{prefix}_sin"] = season_sin(c, period)
        waves[f"{prefix}_cos"] = season_cos(c, period)
    return df.withColumns(waves)


def log1p_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """``ln(1 + x)`` of each column as ``<col>_log``."""
    return df.withColumns({f"{c}_log": F.log1p(F.col(c).cast("double")) for c in cols})


def zero_nonfinite(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NULL, NaN and both infinities by 0 in the numeric columns."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    types = dict(df.dtypes)
    picked = [c for c in (cols or df.columns) if types[c] in numeric or types[c].startswith("decimal")]
    fixed = {}
    for c in picked:
        bad = F.col(c).isNull()
        if types[c] in ("double", "float"):
            bad = bad | F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))
        fixed[c] = F.when(bad, F.lit(0).cast(types[c])).otherwise(F.col(c))
    return df.withColumns(fixed) if fixed else df


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Keep rows with no NULL and no NaN in ``cols`` (default: all columns)."""
    return df.na.drop(how="any", subset=cols)
