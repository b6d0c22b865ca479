"""Grouped distinct counts, means, distinct values, top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_count_by(df: DataFrame, keys: Sequence[str], id_col: str, out: str) -> DataFrame:
    """Distinct ids per group. Spark removes duplicates per (keys, id) before it counts, so a
    hot group is spread over its ids."""
    return df.groupBy(*keys).agg(F.count_distinct(id_col).alias(out))


def mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str = "avg_") -> DataFrame:
    """Mean of several columns per group."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in cols])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Different values of one column."""
    return df.select(col).distinct()


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` rows with the highest ``col``; every task keeps at most ``k`` rows."""
    return df.orderBy(F.col(col).desc_nulls_last()).limit(k)
