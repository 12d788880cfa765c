"""Grouped log-OLS and Gamma regressions from distributed sums.

All models of a job (one per combination of the `by` columns) are fitted
together. Each pass over the rows is one Spark aggregate that leaves k x k sums
per group; only those meet linear algebra, in `mapInPandas` on one row per
group. Sums are partial on the map side, so a group with a third of the rows
is no hot spot there. Group results that are joined back to rows are written
tables with one row per group, which Spark broadcasts by their measured size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions import constants as k
from wattline.functions.tails import chi2_upper, f_upper, normal_two_sided
from wattline.session import cut_lineage

Y = "target_value"
_RANK_CUT = 1e-13


class TooFewObservations(ValueError):
    """A model group has fewer rows than a regression needs."""


@dataclass(frozen=True)
class Fit:
    """One row per group in `frame`: status, n_obs, params, std_err and the model's figures."""

    model_type: str
    by: tuple[str, ...]
    features: tuple[str, ...]
    frame: DataFrame

    @property
    def terms(self) -> list[str]:
        return ["const", *self.features]

    @property
    def usable(self) -> DataFrame:
        return self.frame.filter(F.col("status") == "ok")


# --- rows ---------------------------------------------------------------------


def _number(df: DataFrame, name: str) -> Column:
    """The column as DOUBLE; text that is no number and infinities become NULL."""
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def model_rows(
    df: DataFrame, targets: Sequence[str] = k.TARGETS, features: Sequence[str] = k.FEATURES
) -> DataFrame:
    """Complete rows of every target, stacked: target, bucket_start, machine_id, target_value, features."""
    missing = [c for c in [*targets, *features] if c not in df.columns]
    if missing:
        raise ValueError(f"regression input lacks columns: {missing}")
    values = F.array(*[F.struct(F.lit(t).alias("target"), _number(df, t).alias(Y)) for t in targets])
    return (
        df.select("bucket_start", "machine_id", F.explode(values).alias("_t"), *[_number(df, f).alias(f) for f in features])
        .select("_t.target", "bucket_start", "machine_id", f"_t.{Y}", *features)
        .dropna(subset=["bucket_start", "machine_id", Y, *features])
        .filter(F.col(Y) > 0)
    )


def model_dataset(df: DataFrame, target: str, features: Sequence[str] = k.FEATURES) -> DataFrame:
    """The rows of one target in their published shape."""
    return model_rows(df, [target], features).select(
        "bucket_start", "machine_id", F.col(Y).alias(target), *features
    )


def prepare(rows: DataFrame) -> DataFrame:
    """Write the model rows once; every pass reads them from there."""
    return cut_lineage(rows, "model_rows")


def _scored(rows: DataFrame, guess: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows with their standardised features `_u…` and linear predictor `_eta` under the group's guess."""
    scaled = {
        f"_u{i}": (F.col(f) - F.col("center")[i]) / F.col("spread")[i] for i, f in enumerate(features)
    }
    joined = rows.join(guess, list(by)).withColumns(scaled)
    return joined.withColumn("_eta", _dot("beta", _terms(features)))


# --- sums and small algebra ------------------------------------------------------


def _terms(features: Sequence[str]) -> list[Column]:
    """Constant and standardised features."""
    return [F.lit(1.0), *[F.col(f"_u{i}") for i in range(len(features))]]


def _triangle(terms: Sequence[Column], weight: Column | None = None) -> Column:
    """Sums of all products of two terms, upper triangle by rows."""
    products = [terms[i] * terms[j] for i in range(len(terms)) for j in range(i, len(terms))]
    return F.array(*[F.sum(p if weight is None else p * weight) for p in products])


def _sums(terms: Sequence[Column], value: Column) -> Column:
    return F.array(*[F.sum(t * value) for t in terms])


def _dot(vector: str, terms: Sequence[Column]) -> Column:
    out = F.lit(0.0)
    for i, term in enumerate(terms):
        out = out + F.col(vector)[i] * term
    return out


def _matrix(triangle: Sequence[float], size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = triangle
    return out + np.triu(out, 1).T


def _per_group(df: DataFrame, by: Sequence[str], function, fields: str) -> DataFrame:
    """Apply `function(row) -> dict` to each group's row of sums."""
    keys = T.StructType([df.schema[c] for c in by])
    schema = T.StructType(keys.fields + T.StructType.fromDDL(fields).fields)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = []
            for row in batch.to_dict("records"):
                results.append({**{c: row[c] for c in by}, **function(row)})
            yield pd.DataFrame(results, columns=names)

    return df.mapInPandas(run, schema)


def _start(rows: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """First pass: location and spread of the features, their inverse cross product, the fit of ln y.

    Everything after this pass works on standardised features, whose cross
    product is n times the correlation matrix: well conditioned, whatever the
    units. Spark's covariance aggregates merge centred sums.
    """
    log_y, size, names = F.log(Y), len(features) + 1, list(features)
    pairs = _pairs(names)
    sums = rows.groupBy(*by).agg(
        F.count("*").alias("n_obs"),
        F.array(*[F.avg(f) for f in names]).alias("center"),
        F.array(*[F.stddev_pop(f) for f in names]).alias("deviation"),
        F.array(*[F.covar_pop(f, log_y) for f in names]).alias("covariance"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).cast("array<double>").alias("cross"),
        F.avg(Y).alias("mean_y"),
        F.avg(log_y).alias("mean_log"),
        F.sum(log_y).alias("sum_log"),
        (F.var_pop(log_y) * F.count("*")).alias("log_ss"),
    )

    def solve(row):
        n, deviation = row["n_obs"], np.asarray(row["deviation"])
        spread = np.where(deviation > 0.0, deviation, 1.0)
        gram = np.diag([1.0, *np.where(deviation > 0.0, 1.0, 0.0)])
        for value, (a, b) in zip(row["cross"], pairs):
            i, j = names.index(a), names.index(b)
            gram[i + 1, j + 1] = gram[j + 1, i + 1] = value / (spread[i] * spread[j])
        inverse = np.linalg.pinv(gram, rcond=_RANK_CUT, hermitian=True) / n
        moments = n * np.concatenate([[row["mean_log"]], np.asarray(row["covariance"]) / spread])
        return {
            "status": "ok" if n >= k.MIN_OBSERVATIONS else "too_few_rows",
            "rank": int(np.linalg.matrix_rank(gram, tol=_RANK_CUT * size, hermitian=True)),
            "inverse": inverse.ravel().tolist(),
            "spread": spread.tolist(),
            "beta": (inverse @ moments).tolist(),
            **{c: row[c] for c in ("n_obs", "center", "mean_y", "sum_log", "log_ss")},
        }

    solved = _per_group(
        sums,
        by,
        solve,
        "status string, n_obs long, rank int, inverse array<double>, center array<double>, "
        "spread array<double>, beta array<double>, mean_y double, sum_log double, log_ss double",
    )
    return cut_lineage(solved, "normal_equations")


def _inference(row: dict, beta: Sequence[float], cov: np.ndarray) -> dict:
    """Parameters, errors and normal tails in the units of the features."""
    spread, center = np.asarray(row["spread"]), np.asarray(row["center"])
    back = np.diag(np.concatenate([[1.0], 1.0 / spread]))
    back[0, 1:] = -center / spread
    params = back @ np.asarray(beta)
    error = np.sqrt(np.maximum(np.diag(back @ cov @ back.T), 0.0))
    tails = [normal_two_sided(b / e) if e > 0 else None for b, e in zip(params, error)]
    return {"params": params.tolist(), "std_err": error.tolist(), "p_values": tails}


_NEWTON_RADIUS = 0.5
#: Rows of groups that still move are written apart when they are this part of what is read: one in sixteen.
_FEW = 16
_GUESS = ["inverse", "center", "spread", "beta"]


# --- models -----------------------------------------------------------------------


def fit_log_ols(rows: DataFrame, features: Sequence[str] = k.FEATURES, by: Sequence[str] = ("target",)) -> Fit:
    """Least squares of ln y with HC3 errors; `rows` come from `prepare`."""
    return _finish_log_ols(rows, _start(rows, by, features), features, by)


def _finish_log_ols(rows: DataFrame, start: DataFrame, features: Sequence[str], by: Sequence[str]) -> Fit:
    """Second pass: residuals, leverages and the auxiliary sums of the Breusch-Pagan test."""
    terms, size = _terms(features), len(features) + 1
    leverage = F.lit(0.0)
    for i in range(size):
        for j in range(size):
            leverage = leverage + F.col("inverse")[i * size + j] * terms[i] * terms[j]
    squared = F.col("_e") * F.col("_e")
    shrunk = 1 - F.col("_h")
    sums = (
        _scored(rows, start.filter("status = 'ok'").select(*by, *_GUESS), features, by)
        .withColumns({"_e": F.log(Y) - F.col("_eta"), "_h": leverage})
        .groupBy(*by)
        .agg(
            _triangle(terms, squared / (shrunk * shrunk)).alias("meat"),
            _sums(terms, squared).alias("xe2"),
            F.sum(squared).alias("e2"),
            F.sum(squared * squared).alias("e4"),
        )
    )

    def finish(row):
        inverse = np.asarray(row["inverse"]).reshape(size, size)
        empty = {f: None for f in _OLS_FIGURES}
        base = {"status": row["status"], "n_obs": row["n_obs"]}
        if row["status"] != "ok" or row["meat"] is None:
            return {**base, **empty, "params": None, "std_err": None, "p_values": None}
        n, rank, ssr = row["n_obs"], row["rank"], row["e2"]
        cov = inverse @ _matrix(row["meat"], size) @ inverse
        llf = -n / 2.0 * (math.log(2.0 * math.pi * ssr / n) + 1.0)
        r2 = 1.0 - ssr / row["log_ss"]
        xe2 = np.asarray(row["xe2"])
        level = ssr * ssr / n
        aux_r2 = (float(xe2 @ inverse @ xe2) - level) / (row["e4"] - level)
        f_stat = (aux_r2 / (rank - 1)) / ((1.0 - aux_r2) / (n - rank))
        return {
            **base,
            **_inference(row, row["beta"], cov),
            "aic": -2.0 * llf + 2.0 * rank,
            "bic": -2.0 * llf + rank * math.log(n),
            "rsquared": r2,
            "rsquared_adj": 1.0 - (n - 1.0) / (n - rank) * (1.0 - r2),
            "lm_stat": n * aux_r2,
            "lm_pvalue": chi2_upper(n * aux_r2, rank - 1),
            "f_stat": f_stat,
            "f_pvalue": f_upper(f_stat, rank - 1, n - rank),
        }

    figures = ", ".join(f"{f} double" for f in _OLS_FIGURES)
    frame = _per_group(
        start.join(sums, list(by), "left"),
        by,
        finish,
        f"status string, n_obs long, {figures}, {_VECTORS}",
    )
    return Fit(k.LOG_OLS, tuple(by), tuple(features), cut_lineage(frame, "log_ols"))


_VECTORS = "params array<double>, std_err array<double>, p_values array<double>"
_OLS_FIGURES = ["aic", "bic", "rsquared", "rsquared_adj", "lm_stat", "lm_pvalue", "f_stat", "f_pvalue"]
_GLM_FIGURES = ["aic", "deviance", "null_deviance", "pseudo_r2", "scale"]


def fit_gamma_glm(
    rows: DataFrame,
    features: Sequence[str] = k.FEATURES,
    by: Sequence[str] = ("target",),
    tol: float = 1e-9,
    max_iter: int = 100,
) -> Fit:
    """Gamma regression with log link by iteratively re-weighted least squares."""
    return _finish_gamma_glm(rows, _start(rows, by, features), features, by, tol, max_iter)


def _finish_gamma_glm(
    rows: DataFrame,
    start: DataFrame,
    features: Sequence[str],
    by: Sequence[str],
    tol: float = 1e-9,
    max_iter: int = 100,
) -> Fit:
    """Fisher scoring far from the solution, Newton steps near it.

    With Gamma and log link the working weights of Fisher scoring are 1, so its
    step is a product with the inverse of the first pass. The observed
    information needs the cross products weighted by y / mu; with them the last
    steps converge quadratically, which saves passes over the rows. The fit of
    ln y is the first guess. Each step's coefficients (one row per group) are
    written, which cuts the lineage. Groups that no longer move leave the guess,
    and the join with it then skips their rows. Once the others hold few of the rows,
    these are written apart: a group that needs many more steps does not have all rows
    read for each of them.
    """
    terms, size = _terms(features), len(features) + 1
    by = list(by)
    guess = start.filter("status = 'ok'").select(*by, *_GUESS)
    eta, mu = F.col("_eta"), F.exp("_eta")
    ratio = F.col("_ratio")

    def improve(row):
        slope = np.asarray(row["slope"])
        fisher = np.asarray(row["inverse"]).reshape(size, size) @ slope
        information = _matrix(row["information"], size)
        move = np.linalg.pinv(information, rcond=_RANK_CUT, hermitian=True) @ slope
        if not np.abs(move).max() < _NEWTON_RADIUS:
            move = fisher
        beta = np.asarray(row["beta"]) + move
        kept = {c: row[c] for c in ("inverse", "center", "spread")}
        return {**kept, "beta": beta.tolist(), "moved": float((np.abs(move) / (1.0 + np.abs(beta))).max())}

    ended, moving, sizes = [], None, start.select(*by, "n_obs")
    left, held = rows, sizes.agg(F.sum("n_obs")).first()[0]
    for _ in range(max_iter):
        sums = (
            _scored(left, guess, features, by)
            .withColumn("_ratio", F.col(Y) / mu)
            .groupBy(*by)
            .agg(_sums(terms, ratio - 1).alias("slope"), _triangle(terms, ratio).alias("information"))
        )
        vectors = ", ".join(f"{c} array<double>" for c in _GUESS)
        step = cut_lineage(_per_group(sums.join(guess, by), by, improve, f"{vectors}, moved double"), "irls")
        ended.append(step.filter(F.col("moved") < tol))
        moving = step.filter(~(F.col("moved") < tol))
        guess = moving.drop("moved")
        count = moving.join(sizes, by).agg(F.sum("n_obs")).first()[0]
        if not count:
            break
        if count * _FEW <= held:
            left, held = cut_lineage(left.join(moving.select(*by), by, "left_semi"), "moving_rows"), count
    step = cut_lineage(reduce(DataFrame.unionByName, [*ended, moving]), "fitted")

    sums = (
        _scored(rows, step.drop("moved"), features, by)
        .withColumn("_ratio", F.col(Y) / mu)
        .groupBy(*by)
        .agg(
            F.sum(F.log(Y) - eta).alias("sum_log_ratio"),
            F.sum(ratio).alias("sum_ratio"),
            F.sum((ratio - 1) * (ratio - 1)).alias("pearson"),
        )
        .join(step.select(*by, F.col("beta").alias("fitted"), "moved"), by)
    )

    def finish(row):
        status = row["status"]
        if status == "ok" and not (row["moved"] is not None and row["moved"] < tol):
            status = "not_converged"
        base = {"status": status, "n_obs": row["n_obs"]}
        if status != "ok":
            return {**base, **{f: None for f in _GLM_FIGURES}, "params": None, "std_err": None, "p_values": None}
        n, rank = row["n_obs"], row["rank"]
        inverse = np.asarray(row["inverse"]).reshape(size, size)
        scale = row["pearson"] / (n - rank)
        a = 1.0 / scale
        llf = (
            a * (n * math.log(a) + row["sum_log_ratio"])
            - a * row["sum_ratio"]
            - row["sum_log"]
            - n * math.lgamma(a)
        )
        deviance = 2.0 * (row["sum_ratio"] - n - row["sum_log_ratio"])
        null = 2.0 * (n * math.log(row["mean_y"]) - row["sum_log"])
        return {
            **base,
            **_inference(row, row["fitted"], scale * inverse),
            "aic": -2.0 * llf + 2.0 * rank,
            "deviance": deviance,
            "null_deviance": null,
            "pseudo_r2": 1.0 - deviance / null if null else None,
            "scale": scale,
        }

    figures = ", ".join(f"{f} double" for f in _GLM_FIGURES)
    frame = _per_group(
        start.join(sums, by, "left"),
        by,
        finish,
        f"status string, n_obs long, {figures}, {_VECTORS}",
    )
    return Fit(k.GAMMA_GLM, tuple(by), tuple(features), cut_lineage(frame, "gamma_glm"))


def fit_both(
    rows: DataFrame, features: Sequence[str] = k.FEATURES, by: Sequence[str] = ("target",)
) -> tuple[Fit, Fit]:
    """Log-OLS and Gamma fits that share the first pass."""
    start = _start(rows, by, features)
    return _finish_log_ols(rows, start, features, by), _finish_gamma_glm(rows, start, features, by)


def fit_status(fit: Fit) -> DataFrame:
    """One row per group: model type, observations and status (ok, too_few_rows, not_converged)."""
    return fit.frame.select(*fit.by, F.lit(fit.model_type).alias("model_type"), "n_obs", "status")


def require_observations(*fits: Fit) -> None:
    """Raise when a group could not be fitted; names a few of them."""
    for fit in fits:
        failed = fit.frame.filter(F.col("status") != "ok").select(*fit.by, "status", "n_obs").limit(5).collect()
        if failed:
            shown = "; ".join(", ".join(str(v) for v in row) for row in failed)
            raise TooFewObservations(f"{fit.model_type}: {shown}")


# --- result tables --------------------------------------------------------------------


def parameters(fit: Fit) -> DataFrame:
    """One row per group and parameter, the constant included."""
    names = F.array(*[F.lit(t) for t in fit.terms])
    return (
        fit.usable.select(
            *fit.by, "n_obs", F.explode(F.arrays_zip(names.alias("parameter"), "params", "std_err", "p_values")).alias("_p")
        )
        .select(
            *fit.by,
            F.lit(fit.model_type).alias("model_type"),
            "n_obs",
            "_p.parameter",
            F.col("_p.params").alias("coefficient"),
            "_p.std_err",
            F.col("_p.p_values").alias("p_value"),
        )
    )


def coefficients(fit: Fit) -> DataFrame:
    """Coefficients with normal p-values and 95 % intervals."""
    beta, error = F.col("coefficient"), F.col("std_err")
    return parameters(fit).select(
        *fit.by,
        "model_type",
        "parameter",
        "coefficient",
        "p_value",
        (beta - k.NORMAL_975 * error).alias("ci_lower"),
        (beta + k.NORMAL_975 * error).alias("ci_upper"),
    )


def percent_effect(beta: Column) -> Column:
    """Change of the target in % when a feature grows by one percentage point."""
    return (F.exp(beta * 0.01) - 1) * 100


def direction(effect: Column) -> Column:
    return F.when(effect < 0, k.DECREASES).when(effect > 0, k.INCREASES).otherwise(k.UNCHANGED)


def sensitivity_rank(effects: DataFrame, by: Sequence[str]) -> DataFrame:
    """Dense rank by size of effect within each model; a model has as many rows as features."""
    largest_first = Window.partitionBy(*by, "model_type").orderBy(F.abs("estimated_pct_change_for_1pp").desc())
    return effects.withColumn("absolute_effect_rank", F.dense_rank().over(largest_first).cast("double"))


def sensitivity(coefs: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Effect of one more percentage point of each feature, ranked."""
    effect = F.col("estimated_pct_change_for_1pp")
    effects = (
        coefs.filter(F.col("parameter") != "const")
        .withColumn("estimated_pct_change_for_1pp", percent_effect(F.col("coefficient")))
        .select(
            *by,
            "model_type",
            F.col("parameter").alias("feature"),
            F.col("coefficient").alias("beta"),
            "estimated_pct_change_for_1pp",
            direction(effect).alias("direction"),
            "p_value",
        )
    )
    return sensitivity_rank(effects, by)


_METRICS = ["aic", "bic", "rsquared", "rsquared_adj", "deviance", "null_deviance", "pseudo_r2"]


def stack_models(frames: Sequence[DataFrame]) -> DataFrame:
    """Result rows of several models under each other."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def model_metrics(*fits: Fit) -> DataFrame:
    """Goodness of fit per model; figures a model does not have are NULL."""
    frames = [
        fit.usable.select(
            *fit.by,
            F.lit(fit.model_type).alias("model_type"),
            "n_obs",
            *[
                F.col(m) if m in fit.frame.columns else F.lit(None).cast("double").alias(m)
                for m in _METRICS
            ],
        )
        for fit in fits
    ]
    return stack_models(frames)


def breusch_pagan(ols: Fit) -> DataFrame:
    """Test for unequal residual variance."""
    return ols.usable.select(*ols.by, "lm_stat", "lm_pvalue", "f_stat", "f_pvalue")


def _pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]


def correlation_matrix(
    rows: DataFrame, features: Sequence[str] = k.FEATURES, by: Sequence[str] = ("target",)
) -> DataFrame:
    """Pearson correlations of the features and the target: one row per variable."""
    names = [*features, Y]
    columns = {frozenset(p): f"_r{i}" for i, p in enumerate(_pairs(names))}
    sums = rows.groupBy(*by).agg(*[F.corr(a, b).alias(columns[frozenset((a, b))]) for a, b in _pairs(names)])

    def cell(a: str, b: str) -> Column:
        return F.lit(1.0) if a == b else F.col(columns[frozenset((a, b))])

    lines = [
        F.struct(F.lit(a).alias("variable"), *[cell(a, b).alias(b) for b in names]) for a in names
    ]
    return sums.select(*by, F.explode(F.array(*lines)).alias("_l")).select(*by, "_l.*")


def vif(rows: DataFrame, features: Sequence[str] = k.FEATURES, by: Sequence[str] = ("target",)) -> DataFrame:
    """Variance inflation of each feature: the diagonal of the inverse correlation matrix."""
    pairs, size = _pairs(features), len(features)
    sums = rows.groupBy(*by).agg(F.array(*[F.corr(a, b) for a, b in pairs]).alias("r"), F.count("*").alias("n"))
    names = list(features)

    def invert(row):
        matrix = np.eye(size)
        for value, (a, b) in zip(row["r"], pairs):
            i, j = names.index(a), names.index(b)
            matrix[i, j] = matrix[j, i] = np.nan if value is None else value
        if np.isnan(matrix).any():
            return {"vif": [None] * size}
        return {"vif": np.diag(np.linalg.pinv(matrix, hermitian=True)).tolist()}

    inverted = _per_group(sums, by, invert, "vif array<double>")
    zipped = F.arrays_zip(F.array(*[F.lit(f) for f in names]).alias("feature"), "vif")
    return inverted.select(*by, F.explode(zipped).alias("_v")).select(*by, "_v.feature", "_v.vif")


def univariate_rows(rows: DataFrame, features: Sequence[str] = k.FEATURES) -> DataFrame:
    """One row per feature: (…, feature, x). Feature becomes a group key of the fits."""
    values = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in features])
    kept = [c for c in rows.columns if c not in features]
    return rows.select(*kept, F.explode(values).alias("_f")).select(*kept, "_f.feature", "_f.x")


def univariate_gamma_glm(
    rows: DataFrame, features: Sequence[str] = k.FEATURES, by: Sequence[str] = ("target",)
) -> DataFrame:
    """One Gamma regression per feature; all of them in one grouped fit."""
    keys = [*by, "feature"]
    fit = fit_gamma_glm(univariate_rows(rows, features), ["x"], keys)
    coefs = coefficients(fit).filter(F.col("parameter") == "x")
    figures = fit.usable.select(*keys, "aic", "deviance", "null_deviance", "pseudo_r2", "n_obs")
    effect = F.col("estimated_pct_change_for_1pp")
    return (
        coefs.join(figures, keys)
        .withColumn("estimated_pct_change_for_1pp", percent_effect(F.col("coefficient")))
        .select(
            *keys,
            F.col("coefficient").alias("beta"),
            "p_value",
            "ci_lower",
            "ci_upper",
            "estimated_pct_change_for_1pp",
            direction(effect).alias("direction"),
            "aic",
            "deviance",
            "null_deviance",
            "pseudo_r2",
            "n_obs",
        )
    )


def univariate_order(univariate: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Smallest p-value first, per group."""
    return univariate.orderBy(*by, "p_value")
