"""Model queries with SQL that solves the normal equations by elimination."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import functions as F

from checks import oracle as O
from checks.inputs import PRED, rounded, training_full, training_hourly
from demandspark.operators import linear, metrics, split, validation
from demandspark.plans import hourly as hourly_plans
from demandspark.plans import studies
from demandspark.sources import scratch, standins, tables

TARGET = "target_demanded"
SMALL = ["lead_time", PRED, "running_sum_bookings"]
DIGITS = 4

# Model input of the daily studies, stated here as well so that the SQL does not take it from the library.
SEASONAL = [
    "lead_time", "exp_mov_avg4", "exp_mov_avg5", "exp_mov_avg6", "total_booked_cancelation_prediction_log",
    "total_cancelations_rs_log", "total_bookings_rs_log", "top_booker_amt", "obs_week_sin", "obs_week_cos",
    "obs_day_sin", "obs_day_cos", "del_week_sin", "del_week_cos", "del_day_sin", "del_day_cos",
]
PLAIN = [
    "exp_mov_avg4", "exp_mov_avg5", "exp_mov_avg6", "total_booked_cancelation_prediction_log", "total_cancelations_rs_log",
    "total_bookings_rs_log", "running_sum_bookings", "total_cancelations_rs", "top_booker_amt",
]


def bucket_sql(keys: Sequence[str]) -> str:
    """0 for the fifth of the rows, rounded up, whose hashes come first; 99 for the others."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    rank = f"row_number() OVER (ORDER BY md5(concat_ws('|', {text}, '42')))"
    return f"(CASE WHEN {rank} <= ceil(0.2 * count(*) OVER ()) THEN 0 ELSE 99 END)"


def index_sql(order_by: Sequence[str]) -> str:
    return f"row_number() OVER (ORDER BY {', '.join(order_by)}) - 1"


def kfold_sql(idx: str, n: str, k: int = 10) -> str:
    head = f"(({n} % {k}) * ({n} // {k} + 1))"
    return (
        f"CAST(CASE WHEN {idx} < {head} THEN {idx} // ({n} // {k} + 1)"
        f" ELSE {n} % {k} + ({idx} - {head}) // ({n} // {k}) END AS INT)"
    )


def expanding_sql(idx: str, n: str, k: int = 10) -> str:
    size = f"({n} // {k + 1})"
    return (
        f"CAST(CASE WHEN {idx} < {n} - {k} * {size} THEN 0"
        f" ELSE 1 + ({idx} - ({n} - {k} * {size})) // {size} END AS INT)"
    )


class Ols:
    """CTEs that fit least squares of ``rows`` per ``grp``; ``p`` prefixes their names.

    A feature that does not vary in a group gets the coefficient 0.

    ``combine`` builds each training set from sums per ``grp``: a pair (list of tested folds,
    condition between r.grp and f.fold).
    """

    def __init__(self, p, rows, features, target, train="TRUE", grp="0", combine=None):
        self.p, self.rows, self.features, self.target = p, rows, list(features), target
        self.train, self.grp, self.combine = train, grp, combine

    def ctes(self) -> dict[str, str]:
        p, cols = self.p, [*self.features, self.target]
        last = len(cols)
        z = ["1.0", *[f"z{i}" for i in range(1, last + 1)]]
        pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z)) if i < last]
        sums = [f"g{i}_{j}" for i, j in pairs]
        cell = [[f"g{min(i, j)}_{max(i, j)}" for j in range(len(z))] for i in range(last)]
        matrix = "[" + ", ".join("[" + ", ".join(r) + "]" for r in cell) + "]"
        out = {
            f"{p}c": "SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}" for i, c in enumerate(cols, 1)) + f" FROM {self.rows}",
            f"{p}z": "SELECT t.*, " + ", ".join(f"{c} - m{i} AS z{i}" for i, c in enumerate(cols, 1)) + f" FROM {self.rows} t, {p}c",
            f"{p}g": f"SELECT {self.grp} AS grp, count(*) AS n, "
            + ", ".join(f"sum({z[i]} * {z[j]}) AS g{i}_{j}" for i, j in pairs)
            + f" FROM {p}z WHERE {self.train} GROUP BY 1",
        }
        fitted = f"{p}g"
        if self.combine:
            folds, condition = self.combine
            out[f"{p}t"] = (
                "SELECT f.fold AS grp, CAST(sum(n) AS BIGINT) AS n, "
                + ", ".join(f"sum({s}) AS {s}" for s in sums)
                + f" FROM {p}g r JOIN (SELECT unnest({folds}) AS fold) f ON {condition} GROUP BY 1"
            )
            fitted = f"{p}t"
        self.fitted = fitted
        out[f"{p}a"] = (
            f"SELECT grp, i, j, m[i][j] AS v FROM (SELECT grp, {matrix} AS m FROM {fitted}) t,"
            f" range(1, {last + 1}) a(i), range(1, {last + 2}) b(j)"
        )
        out[f"{p}gj"] = f"""
SELECT grp, 0 AS s, i, j, v FROM {p}a
UNION ALL
SELECT m.grp, m.s + 1, m.i, m.j,
 CASE WHEN abs(d.v) < 1e-8 THEN CASE WHEN m.i = m.s + 1 THEN 0 ELSE m.v END
  WHEN m.i = m.s + 1 THEN r.v / d.v ELSE m.v - c.v * r.v / d.v END
FROM {p}gj m JOIN {p}gj d ON d.grp = m.grp AND d.i = m.s + 1 AND d.j = m.s + 1
JOIN {p}gj r ON r.grp = m.grp AND r.i = m.s + 1 AND r.j = m.j
JOIN {p}gj c ON c.grp = m.grp AND c.i = m.i AND c.j = m.s + 1
WHERE m.s < {last}"""
        raw = f"m{last} + b[1]" + "".join(f" - b[{i + 1}] * m{i}" for i in range(1, last))
        out[f"{p}b"] = (
            f"SELECT t.grp, b, {raw} AS intercept FROM (SELECT grp, list(v ORDER BY i) AS b"
            f" FROM {p}gj WHERE s = {last} AND j = {last + 1} GROUP BY grp) t, {p}c"
        )
        return out

    def predicted(self) -> str:
        last = len(self.features) + 1
        return f"m{last} + b[1]" + "".join(f" + b[{i + 1}] * z{i}" for i in range(1, last))

    def predictions(self, where="TRUE", nonneg=False, extra="") -> str:
        """Rows with ``y`` and ``y_pred``."""
        y = f"abs({self.predicted()})" if nonneg else self.predicted()
        p = self.p
        return (
            f"SELECT {self.grp} AS grp, {extra} z.{self.target} AS y, {y} AS y_pred"
            f" FROM {p}z z JOIN {p}b b ON b.grp = {self.grp}, {p}c WHERE {where}"
        )

    def scale(self, i: int) -> str:
        """Population deviation of feature ``i`` on the training rows."""
        return f"sqrt(greatest(g{i}_{i} / n - (g0_{i} / n) * (g0_{i} / n), 0))"


METRIC_SQL = {
    "mse": "avg((y - y_pred) * (y - y_pred))",
    "rmse": "sqrt(avg((y - y_pred) * (y - y_pred)))",
    "mae": "avg(abs(y - y_pred))",
    "r2": "1 - avg((y - y_pred) * (y - y_pred)) / var_pop(y)",
    "poisson": "2 * avg(CASE WHEN y = 0 THEN y_pred ELSE y * ln(y / y_pred) - y + y_pred END)",
}


def scores_sql(rows: str, names: Sequence[str], by: str = "") -> str:
    cols = ", ".join(f"{METRIC_SQL[m]} AS {m}" for m in names)
    return f"SELECT {by + ', ' if by else ''}{cols} FROM ({rows}) t" + (f" GROUP BY {by}" if by else "")


def tall_sql(rows: str, section: str, names: Sequence[str], item: str = "''") -> str:
    pairs = ", ".join(f"{{'metric': '{m}', 'value': CAST({m} AS DOUBLE)}}" for m in names)
    return (
        f"SELECT section, item, p.metric AS metric, p.value AS value FROM (SELECT '{section}' AS section,"
        f" CAST({item} AS VARCHAR) AS item, unnest([{pairs}]) AS p FROM ({rows}) t) u"
    )


def small_rows(order: bool = False) -> dict[str, str]:
    idx = f", {index_sql(studies.DAILY_ORDER)} AS idx, count(*) OVER () AS total" if order else ""
    return {"rows_": f"SELECT *, {bucket_sql(studies.DAILY_KEY)} AS bucket{idx} FROM v_past_forecasts"}


def ols_views(sql: str, ctes: dict[str, str]) -> str:
    return O.with_views(sql, ctes, recursive=True)


def round_sql(sql: str, cols: Sequence[str], digits: int = DIGITS) -> str:
    return O.rounded(sql, {c: digits for c in cols})


def stored(df, label="study"):
    """Training sets reach the studies as written tables, as they do for a user."""
    return scratch.materialize(df, label)


MODEL_QUERIES: dict = {}


def register(name: str, sql: str | None):
    def add(query):
        MODEL_QUERIES[name] = (query, sql)
        return query

    return add


# ---- operators, on the past forecasts ------------------------------------------------------


@register("train_test_split", O.with_views(f"""
SELECT city_destination, observation_date, delivery_date, bucket < 20 AS is_test FROM rows_""", small_rows()))
def _(spark, d):
    kept = standins.past_forecasts(spark, d).select(*studies.DAILY_KEY)
    train, test = split.hash_split(kept, studies.DAILY_KEY)
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@register("standardised_features", O.with_views(
    "SELECT city_destination, observation_date, delivery_date, "
    + ", ".join(f"round(({c} - m{i}) / s{i}, 6) + 0.0 AS {c}" for i, c in enumerate(SMALL))
    + " FROM rows_, stats WHERE bucket < 20",
    {**small_rows(), "stats": "SELECT "
     + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(SMALL))
     + " FROM rows_ WHERE bucket >= 20"}))
def _(spark, d):
    kept = standins.past_forecasts(spark, d).select(*studies.DAILY_KEY, *SMALL)
    train, test = split.hash_split(kept, studies.DAILY_KEY)
    return rounded(linear.apply_scaler(test, linear.fit_scaler(train, SMALL)), SMALL, 6)


def _side(value: str, test: bool) -> str:
    return f"CASE WHEN bucket {'<' if test else '>='} 20 THEN {value} END"


@register("standardised_sides", O.with_views(
    "SELECT city_destination, observation_date, delivery_date, bucket < 20 AS is_test, "
    + ", ".join(f"round(({c} - m{i}) / s{i}, 6) + 0.0 AS {c}" for i, c in enumerate(SMALL)) + " FROM learned",
    {**small_rows(), "learned": "SELECT *, " + ", ".join(
        f"avg({_side(f'CAST({c} AS DOUBLE)', False)}) OVER () AS m{i}, "
        f"stddev_pop({_side(f'CAST({c} AS DOUBLE)', False)}) OVER () AS s{i}" for i, c in enumerate(SMALL)) + " FROM rows_"}))
def _(spark, d):
    """Both sides of the split, scaled by what the training side taught."""
    kept = standins.past_forecasts(spark, d).select(*studies.DAILY_KEY, *SMALL)
    train, test = split.hash_split(kept, studies.DAILY_KEY)
    scaler = linear.fit_scaler(train, SMALL)
    sides = [linear.apply_scaler(x, scaler).withColumn("is_test", F.lit(x is test)) for x in (train, test)]
    return rounded(sides[0].unionByName(sides[1]), SMALL, 6)


_SMALL_FIT = Ols("s", "rows_", SMALL, TARGET, "bucket >= 20")


def small_split(spark, d):
    return split.hash_split(standins.past_forecasts(spark, d), studies.DAILY_KEY)


@register("least_squares_fit", ols_views(
    "SELECT n AS n_rows, round(intercept, 4) + 0.0 AS intercept, "
    + ", ".join(f"round(b[{i + 2}], 6) + 0.0 AS coef_{c}" for i, c in enumerate(SMALL))
    + " FROM sb JOIN sg USING (grp)", {**small_rows(), **_SMALL_FIT.ctes()}))
def _(spark, d):
    train, _ = small_split(spark, d)
    model = linear.fit_ols(train, SMALL, TARGET)
    return model.select(
        "n_rows",
        (F.round("intercept", 4) + F.lit(0.0)).alias("intercept"),
        *[(F.round(F.get("coef", F.lit(i)), 6) + F.lit(0.0)).alias(f"coef_{c}") for i, c in enumerate(SMALL)],
    )


@register("predictions", ols_views(
    "SELECT city_destination, observation_date, delivery_date, y AS target_demanded,"
    " round(y_pred, 4) + 0.0 AS y_pred, round_even(y_pred, 0) AS y_rounded FROM ("
    + _SMALL_FIT.predictions("bucket < 20", True, "city_destination, observation_date, delivery_date,")
    + ") t", {**small_rows(), **_SMALL_FIT.ctes()}))
def _(spark, d):
    train, test = small_split(spark, d)
    model = linear.pinned(linear.fit_ols(train, SMALL, TARGET))
    scored = linear.predict(test, model, SMALL, nonneg="abs")
    scored = linear.predict(scored, model, SMALL, "y_rounded", nonneg="abs", rounding="even")
    return rounded(scored.select(*studies.DAILY_KEY, TARGET, "y_pred", "y_rounded"), ["y_pred"], 4)


_ALL = list(metrics.ALL_METRICS)
_DIRECT = f"SELECT city_destination, {TARGET} AS y, {PRED} AS y_pred, bucket FROM rows_"


@register("scores_by_city", O.with_views(
    round_sql(scores_sql(_DIRECT, _ALL, "city_destination"), _ALL, 6), small_rows()))
def _(spark, d):
    scores = metrics.regression_metrics(
        standins.past_forecasts(spark, d), TARGET, PRED, _ALL, ["city_destination"]
    )
    return rounded(scores, _ALL, 6)


@register("incumbent_scores", O.with_views(
    round_sql(scores_sql(_DIRECT + " WHERE bucket < 20", ["rmse", "mae", "r2"]), ["rmse", "mae", "r2"], 6), small_rows()))
def _(spark, d):
    _, test = small_split(spark, d)
    names = ["rmse", "mae", "r2"]
    return rounded(metrics.regression_metrics(test, TARGET, PRED, names), names, 6)


def fold_queries(p, rows, features, target, kind, names, section=None):
    """CTEs and SELECT of fold scores (fold, n_train, n_test, metrics, b)."""
    if kind == "kfold":
        fold, combine = kfold_sql("idx", "total"), ("range(0, 10)", "r.grp <> f.fold")
        tested = "TRUE"
    else:
        fold, combine = expanding_sql("idx", "total"), ("range(1, 11)", "r.grp < f.fold")
        tested = "fold > 0"
    ctes = {f"{p}f": f"SELECT *, {fold} AS fold FROM {rows}"}
    ols = Ols(p, f"{p}f", features, target, grp="fold", combine=combine)
    ctes |= ols.ctes()
    scored = ", ".join(f"{METRIC_SQL[m]} AS {m}" for m in names)
    sql = (
        f"SELECT s.*, n AS n_train, b, intercept FROM (SELECT grp AS fold, count(*) AS n_test, {scored}"
        f" FROM ({ols.predictions(tested)}) t GROUP BY 1) s JOIN {p}t r ON r.grp = s.fold JOIN {p}b b ON b.grp = s.fold"
    )
    return ctes, sql


def _fold_sql(kind, names):
    ctes, sql = fold_queries("k", "rows_", SMALL, TARGET, kind, names)
    coefs = ", ".join(f"round(b[{i + 2}], 6) + 0.0 AS coef_{c}" for i, c in enumerate(SMALL))
    shown = ", ".join(f"round({m}, 6) + 0.0 AS {m}" for m in names)
    return ols_views(f"SELECT fold, n_train, n_test, {shown}, {coefs} FROM ({sql}) t", {**small_rows(True), **ctes})


def _shown(scores, names):
    coefs = [(F.round(F.get("coef", F.lit(i)), 6) + F.lit(0.0)).alias(f"coef_{c}") for i, c in enumerate(SMALL)]
    return rounded(scores, names, 6).select("fold", "n_train", "n_test", *names, *coefs)


@register("kfold_scores", _fold_sql("kfold", ["mse", "rmse"]))
def _(spark, d):
    scores = validation.kfold_cv(standins.past_forecasts(spark, d), SMALL, TARGET, studies.DAILY_ORDER)
    return _shown(scores, ["mse", "rmse"])


@register("expanding_scores", _fold_sql("expanding", ["rmse", "mae"]))
def _(spark, d):
    scores = validation.expanding_cv(standins.past_forecasts(spark, d), SMALL, TARGET, studies.DAILY_ORDER)
    return _shown(scores, ["rmse", "mae"])


@register("mean_fold_scores", ols_views(
    (lambda c, s: f"SELECT round(avg(mse), 6) AS mean_mse, round(avg(rmse), 6) AS mean_rmse FROM ({s}) t")(
        *fold_queries("k", "rows_", SMALL, TARGET, "kfold", ["mse", "rmse"])),
    {**small_rows(True), **fold_queries("k", "rows_", SMALL, TARGET, "kfold", ["mse", "rmse"])[0]}))
def _(spark, d):
    scores = validation.kfold_cv(standins.past_forecasts(spark, d), SMALL, TARGET, studies.DAILY_ORDER)
    means = validation.fold_means(scores, ["mse", "rmse"])
    return rounded(means, ["mean_mse", "mean_rmse"], 6)


_COEF_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (g0_{len(SMALL) + 1} / n + m{len(SMALL) + 1}) AS intercept,"
    f" b[{i + 1}] * {_SMALL_FIT.scale(i)} AS coef FROM sb JOIN sg USING (grp), sc"
    for i, c in enumerate(SMALL, 1)
)


@register("coefficient_table", ols_views(
    round_sql(_COEF_ROWS, ["intercept", "coef"]), {**small_rows(), **_SMALL_FIT.ctes()}))
def _(spark, d):
    train, _ = small_split(spark, d)
    model = linear.fit_ols(train, SMALL, TARGET, standardize=True)
    return rounded(linear.coef_table(model, SMALL), ["intercept", "coef"], DIGITS)


@register("importance_table", ols_views(
    f"SELECT feature, round(abs(coef), 4) AS importance FROM ({_COEF_ROWS}) t", {**small_rows(), **_SMALL_FIT.ctes()}))
def _(spark, d):
    train, _ = small_split(spark, d)
    model = linear.fit_ols(train, SMALL, TARGET, standardize=True)
    return rounded(linear.importance_table(model, SMALL), ["importance"], DIGITS)


@register("benchmark_model", O.with_views(f"""
SELECT count(*) AS n_rows, round(regr_intercept({TARGET}, {PRED}), 6) AS intercept,
 round(regr_slope({TARGET}, {PRED}), 6) AS slope FROM rows_ WHERE bucket >= 20""", small_rows()))
def _(spark, d):
    train, _ = small_split(spark, d)
    model = linear.fit_ols(train, [PRED], TARGET)
    shown = model.select("n_rows", "intercept", F.get("coef", F.lit(0)).alias("slope"))
    return rounded(shown, ["intercept", "slope"], 6)


@register("scores_of_city_models", O.with_views(f"""
SELECT city_destination, round(sqrt(avg((y - a - b * x) * (y - a - b * x))), 6) AS rmse FROM (
 SELECT city_destination, {TARGET} AS y, {PRED} AS x, bucket,
  regr_intercept({TARGET}, {PRED}) FILTER (WHERE bucket >= 20) OVER (PARTITION BY city_destination) AS a,
  regr_slope({TARGET}, {PRED}) FILTER (WHERE bucket >= 20) OVER (PARTITION BY city_destination) AS b
 FROM rows_) t WHERE bucket < 20 GROUP BY 1""", small_rows()))
def _(spark, d):
    train, test = small_split(spark, d)
    models = linear.fit_ols(train, [PRED], TARGET, ["city_destination"])
    scored = linear.predict(test, models, [PRED], by=["city_destination"])
    scores = metrics.regression_metrics(scored, TARGET, "y_pred", ["rmse"], ["city_destination"])
    return rounded(scores, ["rmse"], 6)


# ---- studies -------------------------------------------------------------------------------


def full_rows(zero: bool, logs: bool) -> dict[str, str]:
    """Training set of the daily studies as SQL, with index, bucket and model columns."""
    base = {**O.FULL_CTES, "base": O.full_select()}
    waves = ", ".join(
        f"{f}(CAST({c} AS DOUBLE) / {period} * 2 * pi()) AS {p}_{f}"
        for c, (p, period) in studies.DAILY_WAVES.items()
        for f in ("sin", "cos")
    )
    replaced = ", ".join(f"ln(1 + CAST({c} AS DOUBLE)) AS {c}_log" for c in studies.LOGGED[:2])
    cols = f"* REPLACE ({replaced}), ln(1 + CAST(running_sum_bookings AS DOUBLE)) AS running_sum_bookings_log, {waves}" if logs else "*"
    base["featured"] = f"SELECT {cols} FROM base"
    if zero:
        base["clean"] = "SELECT * REPLACE (COALESCE(top_booker_amt, 0) AS top_booker_amt) FROM featured"
    else:
        base["clean"] = "SELECT * FROM featured WHERE top_booker_amt IS NOT NULL"
    base["rows_"] = (
        f"SELECT *, {bucket_sql(studies.DAILY_KEY)} AS bucket, {index_sql(studies.DAILY_ORDER)} AS idx,"
        " count(*) OVER () AS total FROM clean"
    )
    return base


def study_sql(base: dict[str, str], plan: studies.Study, dropped: dict | None = None) -> str:
    """The whole report. ``dropped`` gives, for a feature that is a multiple of another, the
    share both get in the minimum-norm fit: {feature: (twin, standardised, raw)}."""
    dropped = dropped or {}
    fitted = [f for f in plan.features if f not in dropped]
    fold_features = [f for f in (plan.fold_features or plan.features) if f not in dropped]
    train, test = "bucket >= 20", "bucket < 20"
    model = Ols("s", "rows_", fitted, plan.target, train)
    bench = Ols("b", "rows_", [plan.incumbent], plan.target, train)
    ctes = {**base, **model.ctes(), **bench.ctes()}
    nonneg = plan.nonneg == "abs"
    parts = [tall_sql(scores_sql(model.predictions(test, nonneg), plan.holdout), "holdout", plan.holdout)]

    def coefs(f: str) -> tuple[str, str]:
        """(feature column to use, multiplier) under the model's scaling."""
        if f in dropped:
            twin, share, _ = dropped[f]
            return twin, str(share[1])
        for twin, share, _ in dropped.values():
            if twin == f:
                return f, str(share[0])
        return f, "1.0"

    rows, last = [], len(fitted) + 1
    for f in plan.features:
        col, times = coefs(f)
        i = fitted.index(col) + 1
        if plan.standardize:
            rows.append(f"SELECT '{f}' AS feature, g0_{last} / n + m{last} AS intercept, {times} * b[{i + 1}] * {model.scale(i)} AS coef FROM sb JOIN sg USING (grp), sc")
        else:
            rows.append(f"SELECT '{f}' AS feature, intercept, b[{i + 1}] AS coef FROM sb")
    ctes["coefs"] = " UNION ALL ".join(rows)
    parts.append(tall_sql("SELECT * FROM coefs", "coefficients", ["intercept", "coef"], "feature"))
    parts.append(tall_sql(scores_sql(bench.predictions(test, nonneg), plan.holdout), "benchmark", plan.holdout))
    if plan.fold_features:
        parts.append(tall_sql(f"SELECT '{plan.incumbent}' AS feature, abs(b[2]) AS importance FROM bb", "importance", ["importance"], "feature"))
    else:
        parts.append(tall_sql("SELECT feature, abs(coef) AS importance FROM coefs", "importance", ["importance"], "feature"))
    if plan.scores_incumbent:
        names = ["rmse", "mae", "r2"]
        direct = f"SELECT {plan.target} AS y, {plan.incumbent} AS y_pred FROM rows_ WHERE {test}"
        parts.append(tall_sql(scores_sql(direct, names), "incumbent", names))
    for p, kind, names in (("k", "kfold", plan.kfold), ("e", "expanding", plan.expanding)):
        more, sql = fold_queries(p, "rows_", fold_features, plan.target, kind, names)
        ctes |= more
        ctes[f"{kind}_scores"] = sql
        parts.append(tall_sql(f"SELECT * FROM {kind}_scores", kind, names, "fold"))
        means = ", ".join(f"avg({m}) AS mean_{m}" for m in names)
        parts.append(tall_sql(f"SELECT {means} FROM {kind}_scores", kind, [f"mean_{m}" for m in names]))
    for f in plan.fold_features or plan.features:
        col, times = f, "1.0"
        if f in dropped:
            col, times = dropped[f][0], str(dropped[f][2][1])
        for twin, _, share in dropped.values():
            if twin == f:
                times = str(share[0])
        i = fold_features.index(col) + 2
        parts.append(f"SELECT 'expanding_coefficients' AS section, CAST(fold AS VARCHAR) AS item, '{f}' AS metric, {times} * b[{i}] AS value FROM expanding_scores")
    return ols_views(round_sql(" UNION ALL ".join(parts), ["value"]), ctes)


@register("first_daily_study", study_sql(full_rows(False, True), replace(studies.FIRST_DAILY, features=SEASONAL)))
def _(spark, d):
    report = studies.first_daily_study(stored(training_full(spark, d)))
    return rounded(report, ["value"], DIGITS)


@register("second_daily_study", study_sql(full_rows(True, True), replace(studies.SECOND_DAILY, features=SEASONAL)))
def _(spark, d):
    report = studies.second_daily_study(stored(training_full(spark, d)))
    return rounded(report, ["value"], DIGITS)


@register("third_daily_study", study_sql(full_rows(True, False), replace(studies.THIRD_DAILY, features=PLAIN)))
def _(spark, d):
    report = studies.third_daily_study(stored(training_full(spark, d)))
    return rounded(report, ["value"], DIGITS)


@register("csv_daily_study", study_sql(full_rows(True, False), replace(studies.THIRD_DAILY, features=PLAIN)))
def _(spark, d):
    """From a CSV training set to scores."""
    training = training_full(spark, d)
    path = scratch.scratch_path(spark, "training-csv")
    training.write.option("header", True).csv(path)
    report = studies.third_daily_study(tables.read_training_csv(spark, path, training.schema))
    return rounded(report, ["value"], DIGITS)


def hourly_study_rows() -> dict[str, str]:
    waves = ", ".join(
        f"{f}(CAST({c} AS DOUBLE) / {period} * 2 * pi()) AS {p}_{f}"
        for c, (p, period) in studies.HOURLY_WAVES.items()
        for f in ("sin", "cos")
    )
    filled = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in [*O.PROFILE, "total_cancelations_rs"])
    return {
        **O.HOURLY_CTES,
        "base": O.HOURLY_SELECT,
        "rows_": f"SELECT * REPLACE ({filled}), {waves}, {bucket_sql(studies.HOURLY_KEY)} AS bucket,"
        f" {index_sql(studies.HOURLY_ORDER)} AS idx, count(*) OVER () AS total FROM base",
    }


# In the stand-in data the booked share is 1 - lead/7, so the fit splits one effect in two.
_TWIN = {"perc_booked_running_sum": ("lead_time", (0.5, -0.5), (49 / 50, -7 / 50))}


@register("hourly_study", study_sql(
    hourly_study_rows(), studies.hourly_plan(hourly_plans.PROFILE_COLUMNS), _TWIN))
def _(spark, d):
    report = studies.hourly_study(stored(training_hourly(spark, d)), hourly_plans.PROFILE_COLUMNS)
    return rounded(report, ["value"], DIGITS)


_CITY = Ols("s", "rows_", studies.CITY_FEATURES, TARGET, "bucket >= 20", "city_destination")
_CITY_LAST = len(studies.CITY_FEATURES) + 1


@register("city_models", ols_views(
    f"SELECT grp AS city, round(g0_{_CITY_LAST} / n + m{_CITY_LAST}, 4) + 0.0 AS intercept, "
    + ", ".join(f"round(b[{i + 1}] * {_CITY.scale(i)}, 4) + 0.0 AS {c}" for i, c in enumerate(studies.CITY_FEATURES, 1))
    + " FROM sb JOIN sg USING (grp), sc", {**full_rows(True, False), **_CITY.ctes()}))
def _(spark, d):
    models = studies.city_models(training_full(spark, d))
    return rounded(models, ["intercept", *studies.CITY_FEATURES], DIGITS)
