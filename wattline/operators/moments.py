"""Least squares of ln y from stored sums: any range of days, pooled or by machine, without the rows.

A row of moments holds, for one target, machine and day, the number of observations, the means of
the features, of ln y and of y, and the sums of products around these means. Such rows add up: what
lies between two groups' means is added when they are merged, so features far from zero lose no
digits. Merged moments give the coefficients of log-OLS with their classical errors, goodness of
fit, variance inflation and correlations. HC3 errors and the Gamma model need the rows
(`regression`).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions import constants as k
from wattline.operators.regression import Y, _matrix, _per_group
from wattline.session import cut_lineage

#: Names of the two last variables of a row of moments, after the features.
LOG_Y = "log_target"
_RANK_CUT = 1e-13


def daily_moments(rows: DataFrame, features: Sequence[str] = k.FEATURES) -> DataFrame:
    """(target, machine_id, day, n, center, cross) of `regression.model_rows`; `cross` is an upper triangle by rows."""
    values = [*[F.col(f) for f in features], F.log(Y), F.col(Y)]
    pairs = [(a, b) for i, a in enumerate(values) for b in values[i:]]
    count = F.count(F.lit(1))
    return rows.groupBy("target", "machine_id", F.to_date("bucket_start").alias("day")).agg(
        count.alias("n"),
        F.array(*[F.avg(v) for v in values]).alias("center"),
        F.array(*[F.covar_pop(a, b) * count for a, b in pairs]).alias("cross"),
    )


def merge(moments: DataFrame, by: Sequence[str] = ("target",), features: Sequence[str] = k.FEATURES) -> DataFrame:
    """(…by, n, center, cross) of all rows of each group."""
    size, by = len(features) + 2, list(by)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    n = F.col("n")
    means = moments.groupBy(*by).agg(
        F.sum(n).alias("_n"), F.array(*[F.sum(F.col("center")[i] * n) / F.sum(n) for i in range(size)]).alias("_mean")
    )
    # One row per group: written, so that Spark broadcasts it by its measured size.
    joined = moments.join(cut_lineage(means, "moment_means"), by)
    off = [F.col("center")[i] - F.col("_mean")[i] for i in range(size)]
    sums = joined.groupBy(*by).agg(
        F.first("_n").alias("n"),
        F.first("_mean").alias("_mean"),
        F.array(*[F.sum(off[i] * n) for i in range(size)]).alias("_drift"),
        F.array(*[F.sum(F.col("cross")[at] + off[i] * off[j] * n) for at, (i, j) in enumerate(pairs)]).alias("_cross"),
    )
    # The means above are rounded; what that leaves is taken off again.
    drift = F.col("_drift")
    return sums.select(
        *by,
        "n",
        F.array(*[F.col("_mean")[i] + drift[i] / n for i in range(size)]).alias("center"),
        F.array(*[F.col("_cross")[at] - drift[i] * drift[j] / n for at, (i, j) in enumerate(pairs)]).alias("cross"),
    )


@dataclass(frozen=True)
class MomentFit:
    """One row per group in `frame`: status, n_obs and the figures of the fit."""

    by: tuple[str, ...]
    features: tuple[str, ...]
    frame: DataFrame

    @property
    def usable(self) -> DataFrame:
        return self.frame.filter(F.col("status") == "ok")

    @property
    def coefficients(self) -> DataFrame:
        """Coefficients with classical errors, the constant included."""
        names = F.array(*[F.lit(t) for t in ("const", *self.features)]).alias("parameter")
        zipped = F.arrays_zip(names, F.col("params").alias("coefficient"), "std_err")
        return self.usable.select(*self.by, "n_obs", F.inline(zipped))

    @property
    def metrics(self) -> DataFrame:
        return self.usable.select(*self.by, "n_obs", "aic", "bic", "rsquared", "rsquared_adj")

    @property
    def vif(self) -> DataFrame:
        names = F.array(*[F.lit(f) for f in self.features]).alias("feature")
        return self.frame.select(*self.by, F.inline(F.arrays_zip(names, "vif")))

    @property
    def correlation(self) -> DataFrame:
        """Pearson correlations of the features and the target: one row per variable."""
        names = [*self.features, Y]
        size = len(names)
        lines = [
            F.struct(F.lit(a).alias("variable"), *[F.col("correlation")[i * size + j].alias(b) for j, b in enumerate(names)])
            for i, a in enumerate(names)
        ]
        return self.frame.select(*self.by, F.inline(F.array(*lines)))


def fit_log_ols(
    moments: DataFrame, features: Sequence[str] = k.FEATURES, by: Sequence[str] = ("target",)
) -> MomentFit:
    """Least squares of ln y for each group of `by`, from rows of `daily_moments`."""
    size = len(features)

    def solve(row):
        n, center, cross = row["n"], np.asarray(row["center"]), _matrix(row["cross"], size + 2)
        deviation = np.sqrt(np.maximum(np.diag(cross), 0.0))
        spread = np.where(deviation > 0.0, deviation, 1.0)
        related = cross / np.outer(spread, spread)
        flat = deviation <= 0.0
        gram, moments_y = related[:size, :size], related[:size, size]
        inverse = np.linalg.pinv(gram, rcond=_RANK_CUT, hermitian=True)
        beta = inverse @ moments_y * spread[size] / spread[:size]
        rank = 1 + int(np.linalg.matrix_rank(gram, tol=_RANK_CUT * (size + 1), hermitian=True))
        total = cross[size, size]
        ssr = max(total * (1.0 - float(moments_y @ inverse @ moments_y)), 0.0)
        shown = [*range(size), size + 1]
        corr = np.where(np.eye(size + 1, dtype=bool), 1.0, related[np.ix_(shown, shown)])
        unknown = flat[shown][:, None] | flat[shown][None, :]
        corr = [None if u and i != j else float(c) for i, (cs, us) in enumerate(zip(corr, unknown)) for j, (c, u) in enumerate(zip(cs, us))]
        vif = [None] * size if flat[:size].any() else np.diag(np.linalg.pinv(gram, hermitian=True)).tolist()
        out = {"n_obs": n, "vif": vif, "correlation": corr, "status": "ok" if n >= k.MIN_OBSERVATIONS else "too_few_rows"}
        if n <= rank or total <= 0.0 or ssr <= 0.0:
            return {**out, "status": "too_few_rows" if n <= rank else "no_variation", **dict.fromkeys(["params", "std_err", "aic", "bic", "rsquared", "rsquared_adj"])}
        params = [float(center[size] - beta @ center[:size]), *beta.tolist()]
        # Errors of the slopes, and of the constant, which lies the features' means away from the centre.
        covariance = inverse / np.outer(spread[:size], spread[:size]) * ssr / (n - rank)
        at_zero = ssr / (n - rank) / n + float(center[:size] @ covariance @ center[:size])
        errors = np.sqrt(np.maximum([at_zero, *np.diag(covariance)], 0.0))
        llf = -n / 2.0 * (math.log(2.0 * math.pi * ssr / n) + 1.0)
        r2 = 1.0 - ssr / total
        return {
            **out,
            "params": params,
            "std_err": errors.tolist(),
            "aic": -2.0 * llf + 2.0 * rank,
            "bic": -2.0 * llf + rank * math.log(n),
            "rsquared": r2,
            "rsquared_adj": 1.0 - (n - 1.0) / (n - rank) * (1.0 - r2),
        }

    arrays = ", ".join(f"{c} array<double>" for c in ("params", "std_err", "vif", "correlation"))
    figures = ", ".join(f"{c} double" for c in ("aic", "bic", "rsquared", "rsquared_adj"))
    solved = _per_group(merge(moments, by, features), by, solve, f"status string, n_obs long, {arrays}, {figures}")
    return MomentFit(tuple(by), tuple(features), cut_lineage(solved, "moment_fit"))
