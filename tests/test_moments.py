"""Fits from stored moments against fits of the rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.functions import constants as k
from wattline.operators import moments
from wattline.operators import regression as reg


@pytest.fixture(scope="module", params=[0.0, 1e4], ids=["ratios", "large means"])
def rows(request, spark, plant):
    """Model rows; once with features that lie far from zero."""
    shifted = {f: F.col(f) + request.param * (at + 1) for at, f in enumerate(k.FEATURES)}
    return reg.prepare(reg.model_rows(plant.regression_input).withColumns(shifted))


def by_key(df, keys, value):
    return {tuple(row[c] for c in keys): row[value] for row in df.collect()}


@pytest.mark.parametrize("by", [("target",), ("target", "machine_id")])
def test_fits_equal_those_of_the_rows(spark, rows, by):
    daily = moments.daily_moments(rows)
    got, wanted = moments.fit_log_ols(daily, by=by), reg.fit_log_ols(rows, by=by)
    pairs = [
        (got.coefficients, reg.parameters(wanted), [*by, "parameter"], "coefficient"),
        *[(got.metrics, reg.model_metrics(wanted), list(by), m) for m in ("n_obs", "aic", "bic", "rsquared", "rsquared_adj")],
        (got.vif, reg.vif(rows, by=by), [*by, "feature"], "vif"),
        *[(got.correlation, reg.correlation_matrix(rows, by=by), [*by, "variable"], c) for c in (*k.FEATURES, reg.Y)],
    ]
    for ours, theirs, keys, value in pairs:
        a, b = by_key(ours, keys, value), by_key(theirs, keys, value)
        assert a.keys() == b.keys() and a
        for key in a:
            if b[key] is None or (isinstance(b[key], float) and np.isnan(b[key])):
                assert a[key] is None, (key, value)
            elif len(by) == 1 or value in ("n_obs", "rsquared"):
                assert a[key] == pytest.approx(b[key], rel=1e-9, abs=1e-9), (key, value)


def test_classical_errors_equal_numpy(spark, rows):
    fit = moments.fit_log_ols(moments.daily_moments(rows))
    for target in k.TARGETS:
        table = rows.filter(F.col("target") == target).toPandas()
        x, y = table[k.FEATURES].to_numpy(), np.log(table[reg.Y].to_numpy())
        # Around the means; far from zero the plain normal equations lose digits.
        mean = x.mean(axis=0)
        inverse = np.linalg.inv((x - mean).T @ (x - mean))
        left = (y - y.mean()) - (x - mean) @ (inverse @ (x - mean).T @ (y - y.mean()))
        scale = (left**2).sum() / (len(y) - x.shape[1] - 1)
        errors = np.sqrt(scale * np.array([1 / len(y) + mean @ inverse @ mean, *np.diag(inverse)]))
        got = {r.parameter: r.std_err for r in fit.coefficients.filter(F.col("target") == target).collect()}
        assert [got[p] for p in ("const", *k.FEATURES)] == pytest.approx(errors.tolist(), rel=1e-6)


def test_any_range_of_days_is_fitted_from_its_moments(spark, rows):
    daily = moments.daily_moments(rows)
    days = F.col("day").between("2024-01-05", "2024-01-20")
    part = rows.filter(F.to_date("bucket_start").between("2024-01-05", "2024-01-20"))
    got = by_key(moments.fit_log_ols(daily.filter(days)).coefficients, ["target", "parameter"], "coefficient")
    wanted = by_key(reg.parameters(reg.fit_log_ols(reg.prepare(part))), ["target", "parameter"], "coefficient")
    assert got.keys() == wanted.keys()
    assert all(got[key] == pytest.approx(wanted[key], rel=1e-8, abs=1e-8) for key in got)
    assert moments.fit_log_ols(daily.limit(0)).coefficients.count() == 0
    few = moments.fit_log_ols(moments.daily_moments(rows.filter("target = 'system_energy_per_good_part_kwh'").limit(3)))
    assert [r.status for r in few.frame.collect()] == ["too_few_rows"]
