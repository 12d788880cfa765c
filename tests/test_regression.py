"""Regressions against plain numpy fits of the same rows."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest

from wattline.functions.tails import beta_lower, chi2_upper, f_upper, normal_two_sided
from wattline.operators import regression as reg
from wattline.plans import report
from wattline.plans.regression import run_targets

FEATURES = ["availability", "performance", "quality"]
TARGET = "system_energy_per_good_part_kwh"
OTHER = "cycle_energy_per_good_part_kwh"


def data(seed: int, n: int):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.uniform(0.5, 1, n), rng.normal(0.96, 0.01, n), rng.uniform(0.3, 1, n)])
    mu = np.exp(2 - 0.8 * x[:, 0] + 0.4 * x[:, 1] - 1.2 * x[:, 2])
    return x, rng.gamma(6.0, mu / 6.0), rng.gamma(9.0, mu / 18.0)


def frame(spark, groups: dict[str, tuple]):
    rows = []
    for machine, (x, y, z) in groups.items():
        for i in range(len(y)):
            rows.append((datetime(2026, 1, 1) + timedelta(hours=4 * i), machine, *map(float, x[i]), float(y[i]), float(z[i])))
    return spark.createDataFrame(
        rows,
        "bucket_start timestamp_ntz, machine_id string, availability double, performance double, quality double, "
        f"{TARGET} double, {OTHER} double",
    )


def numpy_fits(x, y):
    design = np.column_stack([np.ones(len(y)), x])
    inverse = np.linalg.inv(design.T @ design)
    beta = np.linalg.lstsq(design, np.log(y), rcond=None)[0]
    e = np.log(y) - design @ beta
    h = np.einsum("ij,jk,ik->i", design, inverse, design)
    hc3 = inverse @ (design.T * (e / (1 - h)) ** 2) @ design @ inverse
    gamma = beta.copy()
    for _ in range(200):
        eta = design @ gamma
        gamma = inverse @ design.T @ (eta + y / np.exp(eta) - 1)
    mu = np.exp(design @ gamma)
    scale = (((y - mu) / mu) ** 2).sum() / (len(y) - design.shape[1])
    return beta, np.sqrt(np.diag(hc3)), gamma, np.sqrt(np.diag(scale * inverse)), mu


@pytest.fixture(scope="module")
def groups():
    return {"M1": data(1, 120), "M2": data(2, 60), "M3": data(3, 15)}


@pytest.fixture(scope="module")
def run(spark, groups):
    return run_targets(frame(spark, groups), by=["machine_id"])


def table(fit, machine, target=TARGET):
    rows = {
        r.parameter: (r.coefficient, r.std_err)
        for r in reg.parameters(fit).filter(f"machine_id = '{machine}' and target = '{target}'").collect()
    }
    return np.array([rows[p] for p in ["const", *FEATURES]])


def test_grouped_fits_agree_with_numpy(run, groups):
    for machine, (x, y, _) in groups.items():
        beta, error, gamma, gamma_error, _ = numpy_fits(x, y)
        ols = table(run.log_ols, machine)
        np.testing.assert_allclose(ols[:, 0], beta, rtol=1e-8)
        np.testing.assert_allclose(ols[:, 1], error, rtol=1e-8)
        glm = table(run.gamma_glm, machine)
        np.testing.assert_allclose(glm[:, 0], gamma, rtol=1e-8)
        np.testing.assert_allclose(glm[:, 1], gamma_error, rtol=1e-8)


def test_metrics_and_diagnostics(run, groups):
    x, y, _ = groups["M1"]
    n = len(y)
    beta, _, _, _, mu = numpy_fits(x, y)
    where = f"machine_id = 'M1' and target = '{TARGET}'"
    metrics = {r.model_type: r for r in run.metrics.filter(where).collect()}
    e = np.log(y) - np.column_stack([np.ones(n), x]) @ beta
    llf = -n / 2 * (math.log(2 * math.pi * (e**2).mean()) + 1)
    assert metrics["log_ols"].aic == pytest.approx(-2 * llf + 8, rel=1e-9)
    assert metrics["log_ols"].rsquared == pytest.approx(1 - (e**2).sum() / (n * np.log(y).var()), rel=1e-8)
    deviance = 2 * (-np.log(y / mu) + y / mu - 1).sum()
    assert metrics["gamma_glm"].deviance == pytest.approx(deviance, rel=1e-8)

    design = np.column_stack([np.ones(n), x])
    fitted = design @ np.linalg.lstsq(design, e**2, rcond=None)[0]
    r2 = 1 - ((e**2 - fitted) ** 2).sum() / ((e**2 - (e**2).mean()) ** 2).sum()
    bp = run.breusch_pagan.filter(where).first()
    assert bp.lm_stat == pytest.approx(n * r2, rel=1e-7)
    vifs = {r.feature: r.vif for r in run.vif.filter(where).collect()}
    np.testing.assert_allclose(
        [vifs[f] for f in FEATURES], np.diag(np.linalg.inv(np.corrcoef(x.T))), rtol=1e-9
    )


def test_univariate_models(spark, groups):
    x, y, _ = groups["M1"]
    rows = reg.prepare(reg.model_rows(frame(spark, {"M1": groups["M1"]}), [TARGET]))
    got = {r.feature: r.beta for r in reg.univariate_gamma_glm(rows).collect()}
    for i, feature in enumerate(FEATURES):
        assert got[feature] == pytest.approx(numpy_fits(x[:, [i]], y)[2][1], rel=1e-7)


def test_constant_feature_does_not_break_the_fit(spark):
    x, y, z = data(5, 40)
    x[:, 1] = 1.0
    run = run_targets(frame(spark, {"M": (x, y, z)}))
    coefs = {r.parameter: r.coefficient for r in reg.parameters(run.gamma_glm).filter(f"target = '{TARGET}'").collect()}
    assert all(math.isfinite(v) for v in coefs.values())


def test_too_few_rows_is_an_error_or_left_out(spark, groups):
    small = frame(spark, {"M1": groups["M1"], "tiny": tuple(part[:9] for part in groups["M2"])})
    with pytest.raises(reg.TooFewObservations):
        run_targets(small, by=["machine_id"])
    kept = run_targets(small, by=["machine_id"], strict=False)
    assert {r.machine_id for r in kept.coefficients.collect()} == {"M1"}


def test_rows_that_are_no_numbers_are_left_out(spark):
    rows = [("2026-01-01 00:00:00", "M", str(v), "1", "0.5", "0.5", "0.5") for v in ["1.5", "0", "-1", "inf", "abc", "NaN"]]
    df = spark.createDataFrame(rows, f"bucket_start string, machine_id string, {TARGET} string, {OTHER} string, "
                                     "availability string, performance string, quality string")
    assert [r[TARGET] for r in reg.model_dataset(df, TARGET).collect()] == [1.5]
    with pytest.raises(ValueError, match="lacks columns"):
        reg.model_rows(df.drop("quality"))


def test_tails():
    assert normal_two_sided(1.959963984540054) == pytest.approx(0.05, rel=1e-12)
    assert chi2_upper(7.814727903251179, 3) == pytest.approx(0.05, rel=1e-10)
    assert chi2_upper(5.991464547107979, 2) == pytest.approx(0.05, rel=1e-10)
    assert f_upper(4.0, 1, 1e7) == pytest.approx(normal_two_sided(2.0), rel=1e-5)
    assert beta_lower(2.0, 3.0, 0.4) == pytest.approx(0.5248, rel=1e-12)
    assert beta_lower(0.5, 0.5, 0.25) == pytest.approx(1 / 3, rel=1e-12)


def coefficient_rows(spark, rows):
    return spark.createDataFrame(
        rows, "target string, model_type string, parameter string, coefficient double, p_value double, "
        "ci_lower double, ci_upper double"
    )


def dashboard(spark, target, p_values):
    """The published row for given p-values of (availability, performance, quality)."""
    betas = {"availability": -0.5, "performance": 0.0, "quality": -1.5}
    coefs = coefficient_rows(
        spark,
        [(target, "gamma_glm", "const", 1.0, 0.0, 0.0, 0.0)]
        + [(target, "gamma_glm", f, betas[f], p, 0.0, 0.0) for f, p in zip(FEATURES, p_values)],
    )
    metrics = spark.createDataFrame(
        [(target, "gamma_glm", 42, 1.0, None, None, None, 1.0, 2.0, None)],
        "target string, model_type string, n_obs long, aic double, bic double, rsquared double, "
        "rsquared_adj double, deviance double, null_deviance double, pseudo_r2 double",
    )
    documents = report.model_documents(metrics, coefs, reg.sensitivity(coefs))
    return report.dashboard_rows(documents).first()


def test_report_texts(spark):
    row = dashboard(spark, TARGET, (0.01, 0.6, 0.001))
    assert (row.model_scope, row.display_order, row.n_obs, row.headline) == ("primary", 1, 42, "")
    assert row.significant_features == "minőség és rendelkezésre állás"
    assert row.non_significant_features == "teljesítmény"
    assert row.explanation.startswith("A teljes rendszerenergia / jó darab mutató esetében a minőség és a rendelk")
    assert "minőség javulása 1 százalékponttal várhatóan kb. 1.49%-kal" in row.sensitivity_message
    assert "Pseudo R²: n.a." in row.technical_note

    row = dashboard(spark, TARGET, (0.01, 0.02, 0.6))
    assert "rendelkezésre állás és teljesítmény a legfontosabb tényezők" in row.explanation
    row = dashboard(spark, OTHER, (0.6, 0.01, 0.7))
    assert (row.model_scope, row.display_order) == ("secondary", 2)
    assert "a teljesítmény a legfontosabb tényező." in row.explanation
    row = dashboard(spark, OTHER, (0.01, 0.06, 0.02))
    assert "rendelkezésre állás és minőség a legfontosabb tényezők" in row.explanation
    row = dashboard(spark, OTHER, (0.6, 0.6, 0.6))
    assert row.significant_features == "" and row.explanation.endswith("kiemelhető tényezőt.")
    assert row.sensitivity_message.startswith("A modell alapján most nem")
    assert "Szignifikáns tényezők: nincs" in row.technical_note
    row = dashboard(spark, OTHER, (0.01, 0.02, 0.03))
    assert row.significant_features == "rendelkezésre állás, teljesítmény és minőség"


def test_direction_words(spark):
    coefs = coefficient_rows(spark, [(TARGET, "gamma_glm", "performance", 0.0, 0.5, 0.0, 0.0)])
    assert reg.sensitivity(coefs).first().direction == "nem változtatja"
    assert report.significant_coefficients(coefs).first().direction == "növeli"


def test_passes_read_only_groups_that_still_move(spark, monkeypatch):
    """Twenty groups lie on their curve and end at once; the rows of the noisy one are all that later passes read."""
    easy = {}
    for i in range(20):
        x, _, _ = data(100 + i, 30)
        curve = np.exp(1 - 0.5 * x[:, 0] + 0.3 * x[:, 1] - 0.7 * x[:, 2])
        easy[f"E{i:02d}"] = (x, curve, curve)
    noisy = {"N": data(9, 30)}
    written, cut = [], reg.cut_lineage

    def noted(df, name):
        out = cut(df, name)
        written.append((name, out))
        return out

    def fitted(groups):
        rows = reg.prepare(reg.model_rows(frame(spark, groups), [TARGET]))
        return {r.machine_id: r for r in reg.fit_gamma_glm(rows, by=["target", "machine_id"]).frame.collect()}

    alone = fitted(noisy)["N"]
    monkeypatch.setattr(reg, "cut_lineage", noted)
    found = fitted({**easy, **noisy})
    apart = [df for name, df in written if name == "moving_rows"]
    assert len(apart) == 1 and {r.machine_id for r in apart[0].select("machine_id").distinct().collect()} == {"N"}
    assert apart[0].count() == 30
    assert {r.status for r in found.values()} == {"ok"} and len(found) == 21
    assert found["N"].params == pytest.approx(alone.params, rel=1e-9)
    assert found["N"].std_err == pytest.approx(alone.std_err, rel=1e-9)
