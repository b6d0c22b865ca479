"""Standardisation and least squares by tall-skinny QR.

Each task reduces its rows of (1, features, target) to a triangular factor per group, a batch at a time; factors are
stacked and reduced again, first per salt and then per group, so no task sees more than a few hundred of them. A factor has
the condition of the data, not its square, and carries the values its rows are shifted by, so large means cost no
digits. Only small systems are solved, one row per model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_FIELDS = "n_rows bigint, intercept double, coef array<double>, mean array<double>, scale array<double>"
_CONSTANT = 1e-24  # variance below this share of the squared mean counts as none
_CANCELLED = 1e-26  # likewise for the mean square around the value it was shifted by
_RANK_CUT = 1e-11  # singular values below this share of the largest count as zero
_STACK = 512  # rows that are held per group before they are reduced
_HELD = 2048  # groups that a task holds before it passes on what it has
_SALTS = 64


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations of some columns."""

    cols: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """Learn mean and population deviation; a constant column gets the scale 1."""
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    aggs += [F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs).first()
    mean = [float(row[f"m{i}"] or 0.0) for i in range(len(cols))]
    sd = [float(row[f"s{i}"] or 0.0) for i in range(len(cols))]
    scale = [s if s * s > _CONSTANT * m * m else 1.0 for m, s in zip(mean, sd)]
    return Scaler(tuple(cols), tuple(mean), tuple(scale))


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Replace each column by (x - mean) / scale."""
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(m)) / F.lit(s)
            for c, m, s in zip(scaler.cols, scaler.mean, scaler.scale)
        }
    )


@dataclass
class Factor:
    """Triangular factor ``r`` of n rows (1, z - shift)."""

    n: int
    shift: np.ndarray
    r: np.ndarray

    def moved(self, shift: np.ndarray) -> np.ndarray:
        """The factor of the same rows around another shift."""
        out = self.r.copy()
        out[:, 1:] += np.outer(self.r[:, 0], self.shift - shift)
        return out

    def columns(self, at: Sequence[int]) -> Factor:
        """The factor of some of the columns z."""
        r = self.r[:, [0, *[1 + i for i in at]]]
        return Factor(self.n, self.shift[list(at)], reduced(r))


def reduced(rows: np.ndarray) -> np.ndarray:
    """At most as many rows as columns with the same inner products."""
    return np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows


def stacked(factors: Sequence[Factor]) -> Factor:
    """The factor of all rows together."""
    if not factors:
        raise ValueError("there are no complete rows to learn from")
    shift = factors[0].shift
    rows = np.vstack([f.moved(shift) for f in factors])
    return Factor(sum(f.n for f in factors), shift, reduced(rows))


def factors(df: DataFrame, features: Sequence[str], target: str, group_by: Sequence[str] = ()) -> DataFrame:
    """One row (group, n, shift, r) per group: the triangular factor of (1, features, target).

    Rows that lack a feature or the target (NULL or NaN) are left out. A group costs a few small rows per task however large
    it is, and a task holds at most ``_HELD`` groups.
    """
    keys = list(group_by)
    z = [f"_z{i}" for i in range(len(features) + 1)]
    rows = df.select(*keys, *[F.col(c).cast("double").alias(n) for n, c in zip(z, [*features, target])]).dropna(subset=z)
    types = dict(df.dtypes)
    fields = "".join(f"`{k}` {types[k]}, " for k in keys) + "n bigint, shift array<double>, r array<array<double>>"

    def frame(found: list[tuple[dict, Factor]]) -> pd.DataFrame:
        out = {k: pd.Series([key[k] for key, _ in found], dtype=object) for k in keys}
        out["n"] = [f.n for _, f in found]
        out["shift"] = [f.shift.tolist() for _, f in found]
        out["r"] = [f.r.tolist() for _, f in found]
        return pd.DataFrame(out)

    def groups(batch: pd.DataFrame):
        if not keys:
            yield (), {}, batch
            return
        for _, part in batch.groupby(keys, dropna=False, sort=False):
            key = {k: None if pd.isna(part[k].iloc[0]) else part[k].iloc[0] for k in keys}
            yield tuple(key.values()), key, part

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple[dict, Factor]] = {}
        for batch in batches:
            for name, key, part in groups(batch):
                values = part[z].to_numpy(float)
                before = held.get(name)
                shift = before[1].shift if before else values[0].copy()
                block = np.column_stack([np.ones(len(values)), values - shift])
                n, r = len(values), block
                if before:
                    n, r = n + before[1].n, np.vstack([before[1].r, block])
                held[name] = (key, Factor(n, shift, reduced(r) if len(r) > _STACK else r))
            if len(held) > _HELD:
                yield frame([(k, Factor(f.n, f.shift, reduced(f.r))) for k, f in held.values()])
                held = {}
        if held:
            yield frame([(k, Factor(f.n, f.shift, reduced(f.r))) for k, f in held.values()])

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Factors sorted by group; the last group of a batch may go on in the next."""
        rest: list[tuple[dict, Factor]] = []
        for batch in batches:
            found: list[list[tuple[dict, Factor]]] = [rest] if rest else []
            for row in batch.to_dict("records"):
                key = {k: None if pd.isna(row[k]) else row[k] for k in keys}
                one = (key, Factor(row["n"], np.array(row["shift"]), as_matrix(row["r"])))
                if found and found[-1][0][0] == key:
                    found[-1].append(one)
                else:
                    found.append([one])
            done = [(g[0][0], stacked([f for _, f in g])) for g in found]
            rest = done[-1:]
            if done[:-1]:
                yield frame(done[:-1])
        if rest:
            yield frame(rest)

    made = rows.mapInPandas(reduce_rows, fields)
    salted = made.withColumn("_salt", F.spark_partition_id() % _SALTS)
    first = salted.repartition(*keys, "_salt").sortWithinPartitions("_salt", *keys).drop("_salt").mapInPandas(merge, fields)
    last = first.repartition(*keys).sortWithinPartitions(*keys) if keys else first.coalesce(1)
    return last.mapInPandas(merge, fields)


def as_factor(row) -> Factor:
    return Factor(row["n"], np.array(row["shift"]), as_matrix(row["r"]))


def solve(factor: Factor, standardize: bool = False) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(intercept, coef, mean, scale) of the minimum-norm least-squares fit."""
    n, width = factor.n, factor.r.shape[1]
    r = np.linalg.qr(np.vstack([factor.r, np.zeros((width, width))]), mode="r")  # rows are filled up with zeros
    p = width - 2
    means = factor.shift + r[0, 1:] / r[0, 0]
    x, y = r[1:, 1:-1], r[1:, -1]
    var, square = (x**2).sum(0) / n, (r[:, 1:-1] ** 2).sum(0) / n
    live = var > _CONSTANT * means[:-1] ** 2 + _CANCELLED * square
    sd = np.where(live, np.sqrt(var), 1.0)
    beta = np.zeros(p)
    if live.any():
        d = sd[live]
        u, values, vectors = np.linalg.svd(x[:, live] / d, full_matrices=False)
        vectors = vectors.T
        keep = values > _RANK_CUT * values.max()
        scaled = vectors[:, keep] @ ((u[:, keep].T @ y) / values[keep])
        if not standardize:
            scaled = scaled / d
            if not keep.all():
                # Leave out the part along directions the data does not determine.
                free, _ = np.linalg.qr(vectors[:, ~keep] / d[:, None])
                scaled = scaled - free @ (free.T @ scaled)
        beta[live] = scaled
    if standardize:
        return float(means[-1]), beta, means[:-1], sd
    return float(means[-1] - beta @ means[:-1]), beta, np.zeros(p), np.ones(p)


def as_matrix(lines) -> np.ndarray:
    return np.array([list(line) for line in lines])


def fit_ols(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    group_by: Sequence[str] = (),
    standardize: bool = False,
) -> DataFrame:
    """Least squares with intercept: one model row, or one per group.

    With ``standardize`` the coefficients belong to (x - mean) / scale, learned on the same
    rows; the model row carries both arrays, so predicting needs the raw features only. Rows
    that lack a feature or the target are left out; without any row there is no model.
    """
    keys = list(group_by)
    found = factors(df, features, target, keys)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = [as_factor(row) for row in batch.to_dict("records")]
            fits = [solve(f, standardize) for f in held]
            out = batch[keys].copy()
            out["n_rows"] = [f.n for f in held]
            for i, name in enumerate(["intercept", "coef", "mean", "scale"]):
                out[name] = pd.Series([f[i] for f in fits], index=batch.index, dtype=object)
            yield out.astype({"intercept": float})

    types = dict(df.dtypes)
    key_fields = "".join(f"`{k}` {types[k]}, " for k in keys)
    return found.mapInPandas(fit, key_fields + MODEL_FIELDS)


def fit_ols_by(
    df: DataFrame, key: str, features: Sequence[str], target: str
) -> DataFrame:
    """One standardised model per key, as a flat table: key, intercept, one column per feature."""
    models = fit_ols(df, features, target, [key], standardize=True)
    return models.select(
        key, "intercept", *[F.get("coef", F.lit(i)).alias(c) for i, c in enumerate(features)]
    )


def _linear(intercept: Column, coef, mean, scale, features: Sequence[str]) -> Column:
    total = intercept
    for i, c in enumerate(features):
        total = total + coef(i) * ((F.col(c) - mean(i)) / scale(i))
    return total


def _finish(y: Column, nonneg: str | None, rounding: str | None) -> Column:
    if nonneg not in (None, "abs") or rounding not in (None, "even"):
        raise ValueError("nonneg is None or 'abs', rounding is None or 'even'")
    y = F.abs(y) if nonneg == "abs" else y
    return F.rint(y) if rounding == "even" else y


def predict(
    df: DataFrame,
    model: DataFrame,
    features: Sequence[str],
    out: str = "y_pred",
    nonneg: str | None = None,
    rounding: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add predictions. One model becomes literals in the plan; models per key are joined."""
    if not by:
        row = model.first()
        if row is None:
            raise ValueError("the model has no rows to learn from")
        y = _linear(
            F.lit(row["intercept"]),
            lambda i: F.lit(row["coef"][i]),
            lambda i: F.lit(row["mean"][i]),
            lambda i: F.lit(row["scale"][i]),
            features,
        )
        return df.withColumn(out, _finish(y, nonneg, rounding))
    fields = ["intercept", "coef", "mean", "scale"]
    keys = [F.col(b).alias(f"_key{i}") for i, b in enumerate(by)]
    fitted = model.select(*keys, *[F.col(f).alias(f"_{f}") for f in fields])
    y = _linear(
        F.col("_intercept"),
        lambda i: F.get("_coef", F.lit(i)),
        lambda i: F.get("_mean", F.lit(i)),
        lambda i: F.get("_scale", F.lit(i)),
        features,
    )
    # A NULL key has its own model; rows of a key without a model stay, without a prediction.
    same = reduce(and_, (df[b].eqNullSafe(fitted[f"_key{i}"]) for i, b in enumerate(by)))
    joined = df.join(fitted, same, "left")
    value = F.when(F.col("_coef").isNotNull(), _finish(y, nonneg, rounding))
    return joined.withColumn(out, value).drop(*[f"_{f}" for f in fields], *[f"_key{i}" for i in range(len(by))])


def pinned(model: DataFrame) -> DataFrame:
    """Compute a one-row model now, so later uses do not read the data again."""
    return model.sparkSession.createDataFrame(model.take(1), model.schema)


def coef_table(model: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature, intercept and coefficient of one model."""
    names = F.array(*[F.lit(f) for f in features])
    return model.select("intercept", F.posexplode("coef").alias("_i", "coef")).select(
        F.get(names, F.col("_i")).alias("feature"), "intercept", "coef"
    )


def importance_table(model: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature and absolute coefficient, largest first."""
    return (
        coef_table(model, features)
        .select("feature", F.abs("coef").alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )
