"""Regression scores as one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_METRICS = ("mse", "rmse", "mae", "r2", "poisson")


def metric_columns(y: str, yhat: str, metrics: Sequence[str]) -> list[Column]:
    """Aggregates for the named scores of ``yhat`` against ``y``, over the rows that have both."""
    t, p = F.col(y).cast("double"), F.col(yhat).cast("double")
    both = t.isNotNull() & p.isNotNull()
    t, p = F.when(both, t), F.when(both, p)
    mse = F.avg((t - p) * (t - p))
    spread = F.var_pop(t)
    unusable = (t < 0) | (p <= 0)
    deviance = F.when(
        unusable, F.raise_error(F.lit("Poisson deviance needs y >= 0 and predictions > 0"))
    ).otherwise(F.when(t == 0, p).otherwise(t * F.ln(t / p) - t + p))
    known = {
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(t - p)),
        # A constant target scores 1 when it is met and 0 otherwise.
        "r2": F.when(spread > 0, 1 - mse / spread).otherwise(
            F.when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
        ),
        "poisson": 2 * F.avg(deviance.cast("double")),
    }
    return [known[m].alias(m) for m in metrics]


def regression_metrics(
    df: DataFrame,
    y: str,
    yhat: str,
    metrics: Sequence[str] = ALL_METRICS,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """One row of scores, or one per group."""
    return df.groupBy(*group_by).agg(*metric_columns(y, yhat, metrics))
