"""Contiguous k-fold and expanding-window validation.

The rows at the borders of the folds are found by selection, so nothing is sorted or written. The triangular
factors of all folds come from one pass, and every training set's factor is made of them, so no fold is read again to train.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.operators.linear import MODEL_FIELDS, Factor, as_factor, factors, predict, solve, stacked
from demandspark.operators.metrics import metric_columns
from demandspark.operators.selection import cut_rows, digits, order_statistics


def kfold_starts(n: int, k: int) -> list[int]:
    """First rows of the folds 1..k-1; the first ``n mod k`` folds have one row more."""
    size, longer = divmod(n, k)
    return [i * size + min(i, longer) for i in range(1, k)]


def expanding_starts(n: int, k: int) -> list[int]:
    """First rows of the blocks 1..k: block 0 only trains, each later one is tested on what came before it."""
    size = n // (k + 1)
    return [n - (k - i) * size for i in range(k)]


def with_folds(
    df: DataFrame, order_by: Sequence[str], starts: Mapping[str, Sequence[int]], content: Sequence[str] | None = None
) -> DataFrame:
    """Number the stretches of an order that begin at the given rows, one column per name."""
    keys = digits(df, order_by, content)
    ranks = sorted({r for found in starts.values() for r in found})
    cuts = dict(zip(ranks, order_statistics(df, keys, ranks)))
    return cut_rows(df, keys, {name: [cuts[r] for r in found] for name, found in starts.items()})


def fold_models(
    parts: Mapping[int, Factor],
    folds: Sequence[int],
    trains_on: Callable[[int, int], bool],
) -> list[tuple[int, int, float, list[float]]]:
    """(fold, rows, intercept, coef) per tested fold, from the factor of each fold."""
    models = []
    for fold in folds:
        factor = stacked([m for f, m in sorted(parts.items()) if trains_on(f, fold)])
        intercept, coef, _, _ = solve(factor)
        models.append((fold, factor.n, intercept, coef.tolist()))
    return models


def other_folds(fold: int, tested: int) -> bool:
    return fold != tested


def earlier_folds(fold: int, tested: int) -> bool:
    return fold < tested


def _models_of(rows, features, target, folds, trains_on) -> DataFrame:
    # At most k + 1 factors reach the driver.
    parts = {r["fold"]: as_factor(r) for r in factors(rows, features, target, ["fold"]).collect()}
    p = len(features)
    models = [
        (*model, [0.0] * p, [1.0] * p) for model in fold_models(parts, folds, trains_on)
    ]
    return rows.sparkSession.createDataFrame(models, f"fold int, {MODEL_FIELDS}")


def _scored(rows, models, features, target, metrics):
    # One model row per fold: k rows, so the join is a broadcast of a fixed size.
    predicted = predict(rows, F.broadcast(models), features, "_y_pred", by=["fold"])
    scores = predicted.groupBy("fold").agg(
        F.count("*").alias("n_test"), *metric_columns(target, "_y_pred", metrics)
    )
    kept = models.select("fold", F.col("n_rows").alias("n_train"), "intercept", "coef")
    return scores.join(F.broadcast(kept), "fold").select(
        "fold", "n_train", "n_test", *metrics, "intercept", "coef"
    )


def kfold_cv(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order_by: Sequence[str],
    k: int = 10,
    metrics: Sequence[str] = ("mse", "rmse"),
) -> DataFrame:
    """Scores and coefficients per contiguous fold, each tested on the model of the others."""
    rows = df.select(*dict.fromkeys([*order_by, *features, target]))
    n = rows.count()
    if n < max(k, 2):
        raise ValueError(f"{n} rows cannot fill {k} folds")
    rows = with_folds(rows, order_by, {"fold": kfold_starts(n, k)})
    models = _models_of(rows, features, target, range(k), other_folds)
    return _scored(rows, models, features, target, metrics)


def expanding_cv(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order_by: Sequence[str],
    k: int = 10,
    metrics: Sequence[str] = ("rmse", "mae"),
) -> DataFrame:
    """Scores and coefficients of k equal test blocks, each trained on all rows before it."""
    rows = df.select(*dict.fromkeys([*order_by, *features, target]))
    n = rows.count()
    if n < k + 1:
        raise ValueError(f"{n} rows cannot fill {k + 1} blocks")
    rows = with_folds(rows, order_by, {"fold": expanding_starts(n, k)})
    models = _models_of(rows, features, target, range(1, k + 1), earlier_folds)
    return _scored(rows.filter("fold > 0"), models, features, target, metrics)


def fold_means(scores: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean of each score over the folds."""
    return scores.agg(*[F.avg(m).alias(f"mean_{m}") for m in metrics])
