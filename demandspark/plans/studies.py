"""Model studies: hold-out scores, coefficients, fold scores, benchmark and incumbent.

Folds and the split are marks on the rows, whose borders are found by selection. Every figure is an
aggregation over the marked rows; the report is a tall table (section, item, metric, value).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.scalars import (
    cyclical,
    drop_missing,
    log1p_features,
    zero_nonfinite,
)
from demandspark.operators.linear import (
    Factor,
    as_factor,
    factors,
    fit_ols,
    fit_ols_by,
    solve,
    stacked,
)
from demandspark.operators.metrics import metric_columns
from demandspark.operators.split import hash_split, with_test_mark
from demandspark.operators.validation import (
    earlier_folds,
    expanding_starts,
    fold_models,
    kfold_starts,
    other_folds,
    with_folds,
)

PREDICTION = "total_booked_cancelation_prediction"

# Period of each calendar column and the prefix of its two waves.
DAILY_WAVES = {
    "observation_date_w": ("obs_week", 52),
    "observation_date_d": ("obs_day", 7),
    "delivery_date_w": ("del_week", 52),
    "delivery_date_d": ("del_day", 7),
}
HOURLY_WAVES = {"delivery_date_h": ("delivery_date_h", 24), "delivery_date_dow": ("delivery_date_dow", 7)}
LOGGED = [PREDICTION, "total_cancelations_rs", "running_sum_bookings"]

SMOOTHED = ["exp_mov_avg4", "exp_mov_avg5", "exp_mov_avg6"]
LOGS = [f"{PREDICTION}_log", "total_cancelations_rs_log", "total_bookings_rs_log"]
WAVE_FEATURES = [f"{p}_{w}" for p, _ in DAILY_WAVES.values() for w in ("sin", "cos")]
SEASONAL_FEATURES = ["lead_time", *SMOOTHED, *LOGS, "top_booker_amt", *WAVE_FEATURES]
PLAIN_FEATURES = [
    *SMOOTHED,
    *LOGS,
    "running_sum_bookings",
    "total_cancelations_rs",
    "top_booker_amt",
]
CITY_FEATURES = [*SMOOTHED, "top_booker_amt"]
DAILY_KEY = ["city_destination", "observation_date", "delivery_date"]
DAILY_ORDER = ["observation_date", "delivery_date", "city_destination"]
HOURLY_KEY = ["forecast_id"]
HOURLY_ORDER = ["booked_start_at_local", "lead_time", "city_destination"]


TEST_SHARE = 0.2


@dataclass(frozen=True)
class Study:
    """What a study fits and how it scores."""

    features: Sequence[str]
    target: str
    incumbent: str
    key: Sequence[str]
    order_by: Sequence[str]
    standardize: bool = True
    nonneg: str | None = "abs"
    holdout: Sequence[str] = ("rmse", "mae", "poisson", "r2")
    kfold: Sequence[str] = ("rmse",)
    expanding: Sequence[str] = ("rmse", "mae")
    fold_features: Sequence[str] = field(default_factory=tuple)
    scores_incumbent: bool = True
    folds: int = 10


FIRST_DAILY = Study(
    SEASONAL_FEATURES,
    "target_demanded",
    PREDICTION,
    DAILY_KEY,
    DAILY_ORDER,
    standardize=False,
    nonneg=None,
    holdout=("mse", "r2"),
    kfold=("mse",),
    expanding=("mse",),
    fold_features=(PREDICTION,),
    scores_incumbent=False,
)
SECOND_DAILY = Study(
    SEASONAL_FEATURES, "target_demanded", PREDICTION, DAILY_KEY, DAILY_ORDER, expanding=("rmse",)
)
THIRD_DAILY = Study(PLAIN_FEATURES, "target_demanded", PREDICTION, DAILY_KEY, DAILY_ORDER)


def hourly_features(profile: Sequence[str]) -> list[str]:
    """Model input of the hourly study, ``profile`` being the slot profile columns."""
    return [
        "delivery_date_weekday",
        "lead_time",
        "total_booked_rs",
        "perc_booked_running_sum",
        *profile,
        "total_cancelations_rs",
        *[f"{p}_{w}" for p, _ in HOURLY_WAVES.values() for w in ("sin", "cos")],
    ]


def hourly_plan(profile: Sequence[str]) -> Study:
    return Study(hourly_features(profile), "target", "old_forecast", HOURLY_KEY, HOURLY_ORDER)


def seasonal_rows(training: DataFrame) -> DataFrame:
    """Add calendar waves and ``log1p`` columns; the latter replace stored logarithms."""
    return log1p_features(cyclical(training, DAILY_WAVES), LOGGED)


def hourly_rows(training: DataFrame) -> DataFrame:
    return zero_nonfinite(cyclical(training, HOURLY_WAVES))


def _by_fold(fold: str, values: Sequence[float]) -> Column:
    """The value of a row's fold, from a short list of constants."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.col(fold))


def _fold_prediction(fold: str, models: Sequence[tuple], features: Sequence[str], first: int) -> Column:
    """Prediction of each row by the model that was not trained on it."""
    pad = [0.0] * first
    y = _by_fold(fold, [*pad, *[m[2] for m in models]])
    for i, c in enumerate(features):
        y = y + _by_fold(fold, [*pad, *[m[3][i] for m in models]]) * F.col(c)
    return y


def _fitted_prediction(model: Sequence, features: Sequence[str], nonneg: str | None) -> Column:
    intercept, coef, mean, scale = model
    y = F.lit(float(intercept))
    for c, b, m, s in zip(features, coef, mean, scale):
        y = y + F.lit(float(b)) * ((F.col(c) - F.lit(float(m))) / F.lit(float(s)))
    return F.abs(y) if nonneg == "abs" else y


def _scores(rows: DataFrame, target: str, predictions: Sequence[Column]) -> dict[tuple[str, str], dict]:
    """All scores of all sections in one pass: (section, item) -> scores.

    A prediction is a struct (section, item, y_pred, positive) or NULL where it does not apply;
    ``positive`` repeats it for the deviance where a section asks for that.
    """
    one = rows.select(F.col(target).alias("_y"), F.explode(F.array(*predictions)).alias("_p"))
    flat = one.filter(F.col("_p").isNotNull()).select("_y", "_p.*")
    scored = flat.groupBy("section", "item").agg(
        *metric_columns("_y", "y_pred", ["mse", "rmse", "mae", "r2"]),
        *metric_columns("_y", "positive", ["poisson"]),
    )
    # One row per section and fold.
    return {(r["section"], r["item"]): r.asDict() for r in scored.collect()}


def _prediction(section: str, y: Column, metrics: Sequence[str], item: Column | None = None, when: Column | None = None) -> Column:
    packed = F.struct(
        F.lit(section).alias("section"),
        (F.lit("") if item is None else item.cast("string")).alias("item"),
        y.cast("double").alias("y_pred"),
        (y if "poisson" in metrics else F.lit(None)).cast("double").alias("positive"),
    )
    return packed if when is None else F.when(when, packed)


def run_study(
    rows: DataFrame,
    plan: Study,
    model_rows: DataFrame | None = None,
) -> DataFrame:
    """Full report of one study.

    Two passes over the marked rows serve every model: triangular factors per fold,
    block and side of the split, and scores; a few passes over the keys find the marks. The driver sees a few small matrices and one row
    of scores per fold. ``model_rows`` feed the hold-out model when they differ from ``rows``.
    """
    columns = list(dict.fromkeys([*plan.features, plan.incumbent]))
    fold_features = list(plan.fold_features or plan.features)
    k, direct = plan.folds, ("rmse", "mae", "r2")
    used = rows.select(*dict.fromkeys([*plan.key, *plan.order_by, *columns, plan.target]))
    n = used.count()
    if n < k + 1:
        raise ValueError(f"{n} rows cannot fill {k + 1} blocks")
    folded = with_folds(used, plan.order_by, {"_kfold": kfold_starts(n, k), "_block": expanding_starts(n, k)})
    marked = with_test_mark(folded, plan.key, TEST_SHARE, out="_test", rows=n)
    held = [
        (r["_kfold"], r["_block"], r["_test"], as_factor(r))
        for r in factors(marked, columns, plan.target, ["_kfold", "_block", "_test"]).collect()
    ]

    def part(features, keep) -> Factor:
        at = [*[columns.index(f) for f in features], len(columns)]
        return stacked([f for *key, f in held if keep(*key)]).columns(at)

    train = (lambda kf, bl, test: not test)
    if model_rows is None:
        model = solve(part(plan.features, train), plan.standardize)
    else:
        model_train, model_test = hash_split(model_rows, plan.key)
        row = fit_ols(model_train, plan.features, plan.target, standardize=plan.standardize).first()
        model = (row["intercept"], row["coef"], row["mean"], row["scale"])
    bench = solve(part([plan.incumbent], train))
    by_fold = {f: part(fold_features, lambda kf, bl, test, f=f: kf == f) for f in range(k)}
    by_block = {b: part(fold_features, lambda kf, bl, test, b=b: bl == b) for b in range(k + 1)}
    kfold = fold_models(by_fold, range(k), other_folds)
    expanding = fold_models(by_block, range(1, k + 1), earlier_folds)

    is_test = F.col("_test")
    fitted = _fitted_prediction(model, plan.features, plan.nonneg)
    predictions = [
        _prediction(
            "benchmark", _fitted_prediction(bench, [plan.incumbent], plan.nonneg), plan.holdout, when=is_test
        ),
        _prediction(
            "kfold", _fold_prediction("_kfold", kfold, fold_features, 0), plan.kfold, F.col("_kfold")
        ),
        _prediction(
            "expanding",
            _fold_prediction("_block", expanding, fold_features, 1),
            plan.expanding,
            F.col("_block"),
            F.col("_block") > 0,
        ),
    ]
    if plan.scores_incumbent:
        predictions.append(_prediction("incumbent", F.col(plan.incumbent), direct, when=is_test))
    holdout = _prediction("holdout", fitted, plan.holdout)
    if model_rows is None:
        predictions.append(F.when(is_test, holdout))
    scores = _scores(marked, plan.target, predictions)
    if model_rows is not None:
        scores |= _scores(model_test, plan.target, [holdout])

    shown, coef, intercept = plan.features, model[1], float(model[0])
    report = [("coefficients", f, "intercept", intercept) for f in shown]
    report += [("coefficients", f, "coef", float(b)) for f, b in zip(shown, coef)]
    if plan.fold_features:
        # This study lists the importance of the model it fitted last, the benchmark.
        shown, coef = [plan.incumbent], bench[1]
    report += [("importance", f, "importance", abs(float(b))) for f, b in zip(shown, coef)]
    wanted = {
        "holdout": plan.holdout,
        "benchmark": plan.holdout,
        "incumbent": direct,
        "kfold": plan.kfold,
        "expanding": plan.expanding,
    }
    for (section, item), row in scores.items():
        report += [(section, item, m, row[m]) for m in wanted[section]]
    for section in ("kfold", "expanding"):
        for m in wanted[section]:
            values = [row[m] for (name, _), row in scores.items() if name == section]
            report.append((section, "", f"mean_{m}", float(np.mean(values))))
    for fold, _, _, values in expanding:
        report += [("expanding_coefficients", str(fold), f, v) for f, v in zip(fold_features, values)]
    fields = "section string, item string, metric string, value double"
    return rows.sparkSession.createDataFrame(report, fields)


def first_daily_study(training: DataFrame) -> DataFrame:
    """Seasonal features, rows with gaps dropped, unscaled; folds use the prediction alone."""
    rows = seasonal_rows(training)
    needed = [*FIRST_DAILY.key, *FIRST_DAILY.features, FIRST_DAILY.target]
    model_rows = drop_missing(rows.select(*needed), [*FIRST_DAILY.features, FIRST_DAILY.target])
    return run_study(drop_missing(rows), FIRST_DAILY, model_rows)


def second_daily_study(training: DataFrame) -> DataFrame:
    """Seasonal features, gaps set to 0, standardised."""
    return run_study(zero_nonfinite(seasonal_rows(training)), SECOND_DAILY)


def third_daily_study(training: DataFrame) -> DataFrame:
    """Training-set columns only, gaps set to 0, standardised."""
    return run_study(zero_nonfinite(training), THIRD_DAILY)


def hourly_study(training: DataFrame, profile: Sequence[str]) -> DataFrame:
    """Hourly features with waves of hour and weekday, gaps set to 0, standardised."""
    return run_study(hourly_rows(training), hourly_plan(profile))


def city_models(training: DataFrame) -> DataFrame:
    """One standardised model per city, fitted on the city's training rows."""
    rows = zero_nonfinite(training)
    train, _ = hash_split(rows, DAILY_KEY)
    models = fit_ols_by(train, "city_destination", CITY_FEATURES, "target_demanded")
    return models.withColumnRenamed("city_destination", "city")
