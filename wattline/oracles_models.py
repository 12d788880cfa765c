"""DuckDB SQL for the regressions and the report rows built on them.

A least-squares coefficient is a weighted sum of the responses. The weights
`a0..ak` of each row come from centred covariances in closed form; since Gamma
regression with log link has unit working weights, the same `a` serve every
step of it. Steps are unrolled as CTEs.
"""

from __future__ import annotations

from wattline.oracles import PARTS, QUERIES

STEPS = 40
_P, _S = "system_energy_per_good_part_kwh", "cycle_energy_per_good_part_kwh"
_FEATURES = ["availability", "performance", "quality"]


def _normal_tail(z: str) -> str:
    """P(|Z| > |z|): one minus twice a Simpson integral of the density from 0 to |z|."""
    width = f"(least(abs({z}), 12.0) / 2000.0)"
    weight = "CASE WHEN i IN (0, 2000) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END"
    area = f"list_sum(list_transform(range(0, 2001), lambda i: ({weight}) * exp(-0.5 * (i * {width}) ** 2)))"
    return f"(1.0 - 2.0 * ({width} / 3.0) * {area} / sqrt(2.0 * pi()))"


def _f_tail(f: str, df2: str) -> str:
    """P(F > f) for 3 and df2 degrees of freedom: a Simpson integral of the beta density over s = sqrt(t)."""
    width = f"(sqrt(3.0 * {f} / ({df2} + 3.0 * {f})) / 4000.0)"
    weight = "CASE WHEN i IN (0, 4000) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END"
    density = f"2.0 * (i * {width}) ** 2 * (1.0 - (i * {width}) ** 2) ** ({df2} / 2.0 - 1.0)"
    area = f"list_sum(list_transform(range(0, 4001), lambda i: ({weight}) * {density}))"
    log_beta = f"(lgamma(1.5) + lgamma({df2} / 2.0) - lgamma(1.5 + {df2} / 2.0))"
    return f"(1.0 - ({width} / 3.0) * {area} / exp({log_beta}))"


PARTS["mrows"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS target, bucket_start, machine_id, {t} AS y, "
    "availability AS x1, performance AS x2, quality AS x3 FROM input4h "
    f"WHERE {t} > 0"
    for t in (_P, _S)
)


def _three_features(prefix: str, group: str) -> None:
    """Row weights of the regression on three features, grouped by `group`."""
    pairs = [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3)]
    PARTS[f"{prefix}_rows"] = f"SELECT *, {group} AS g FROM mrows"
    PARTS[f"{prefix}_stats"] = (
        "SELECT g, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, "
        + ", ".join(f"covar_pop(x{i}, x{j}) AS s{i}{j}" for i, j in pairs)
        + f" FROM {prefix}_rows GROUP BY g"
    )
    PARTS[f"{prefix}_inv"] = f"""
SELECT g, n, m1, m2, m3, (s22*s33 - s23*s23) / det AS i11, (s13*s23 - s12*s33) / det AS i12,
  (s12*s23 - s13*s22) / det AS i13, (s11*s33 - s13*s13) / det AS i22, (s12*s13 - s11*s23) / det AS i23,
  (s11*s22 - s12*s12) / det AS i33
FROM (SELECT *, s11*(s22*s33 - s23*s23) - s12*(s12*s33 - s13*s23) + s13*(s12*s23 - s13*s22) AS det
      FROM {prefix}_stats)"""
    PARTS[f"{prefix}_weights"] = f"""
SELECT *, 1.0/n - m1*a1 - m2*a2 - m3*a3 AS a0, 1.0/n + (x1-m1)*a1 + (x2-m2)*a2 + (x3-m3)*a3 AS h
FROM (SELECT r.*, n, m1, m2, m3,
    (i11*(x1-m1) + i12*(x2-m2) + i13*(x3-m3)) / n AS a1,
    (i12*(x1-m1) + i22*(x2-m2) + i23*(x3-m3)) / n AS a2,
    (i13*(x1-m1) + i23*(x2-m2) + i33*(x3-m3)) / n AS a3
  FROM {prefix}_rows r JOIN {prefix}_inv i ON i.g = r.g)"""


def _one_feature(prefix: str, group: str = "target") -> None:
    """Row weights of the regressions on one feature each, grouped by `group`."""
    PARTS[f"{prefix}_rows"] = "\nUNION ALL\n".join(
        f"SELECT target, '{name}' AS feature, {group} || '|{name}' AS g, y, x{i} AS x1 FROM mrows"
        for i, name in enumerate(_FEATURES, 1)
    )
    PARTS[f"{prefix}_weights"] = f"""
SELECT *, 1.0/n - m1*a1 AS a0
FROM (SELECT r.*, n, m1, (x1-m1) / (s11 * n) AS a1
  FROM {prefix}_rows r JOIN (SELECT g, count(*) AS n, avg(x1) AS m1, var_pop(x1) AS s11
                             FROM {prefix}_rows GROUP BY g) i ON i.g = r.g)"""


def _gamma_steps(prefix: str, size: int) -> None:
    ids = range(size + 1)
    eta = "b0 + " + " + ".join(f"b{i} * x{i}" for i in ids if i)
    PARTS[f"{prefix}_ols"] = (
        "SELECT g, any_value(n) AS n, "
        + ", ".join(f"sum(a{i} * ln(y)) AS b{i}" for i in ids)
        + f" FROM {prefix}_weights GROUP BY g"
    )
    before = f"{prefix}_ols"
    for step in range(1, STEPS + 1):
        PARTS[f"{prefix}_s{step}"] = (
            "SELECT g, any_value(n) AS n, "
            + ", ".join(f"sum(a{i} * (eta + y / exp(eta) - 1.0)) AS b{i}" for i in ids)
            + f" FROM (SELECT w.*, {eta} AS eta FROM {prefix}_weights w JOIN {before} b ON b.g = w.g) GROUP BY g"
        )
        before = f"{prefix}_s{step}"
    k = size + 1
    PARTS[f"{prefix}_glm"] = f"""
SELECT g, any_value(n) AS n, {", ".join(f"any_value(b{i}) AS b{i}" for i in ids)},
  sum((y/mu - 1.0) ** 2) / (any_value(n) - {k}) AS scale,
  2.0 * sum(-ln(y/mu) + y/mu - 1.0) AS deviance, sum(ln(y/mu)) AS slr, sum(y/mu) AS sr, sum(ln(y)) AS sl,
  2.0 * sum(-ln(y/mean_y) + y/mean_y - 1.0) AS null_deviance,
  {", ".join(f"sum(a{i} * a{i}) AS c{i}" for i in ids)}
FROM (SELECT w.*, {", ".join(f"b{i}" for i in ids)}, exp({eta}) AS mu, avg(y) OVER (PARTITION BY w.g) AS mean_y
      FROM {prefix}_weights w JOIN {before} b ON b.g = w.g) GROUP BY g"""
    PARTS[f"{prefix}_glm_metrics"] = f"""
SELECT g, n, deviance, null_deviance, 1.0 - deviance / null_deviance AS pseudo_r2,
  -2.0 * (a * (n * ln(a) + slr) - a * sr - sl - n * lgamma(a)) + 2.0 * {k} AS aic
FROM (SELECT *, 1.0 / scale AS a FROM {prefix}_glm)"""


def _ols_errors(prefix: str) -> None:
    PARTS[f"{prefix}_resid"] = f"""
SELECT w.*, b0, b1, b2, b3, ln(y) - (b0 + b1*x1 + b2*x2 + b3*x3) AS e
FROM {prefix}_weights w JOIN {prefix}_ols b ON b.g = w.g"""
    PARTS[f"{prefix}_hc3"] = (
        "SELECT g, any_value(n) AS n, "
        + ", ".join(f"any_value(b{i}) AS b{i}, sqrt(sum((a{i} * e / (1.0 - h)) ** 2)) AS se{i}" for i in range(4))
        + ", sum(e * e) AS ssr, sum(e * e * e * e) AS e4, var_pop(ln(y)) * count(*) AS sst"
        + f" FROM {prefix}_resid GROUP BY g"
    )
    PARTS[f"{prefix}_params"] = "\nUNION ALL\n".join(
        [
            f"SELECT g, 'log_ols' AS model_type, n, '{name}' AS parameter, b{i} AS b, se{i} AS se FROM {prefix}_hc3"
            for i, name in enumerate(["const", *_FEATURES])
        ]
        + [
            f"SELECT g, 'gamma_glm', n, '{name}', b{i}, sqrt(scale * c{i}) FROM {prefix}_glm"
            for i, name in enumerate(["const", *_FEATURES])
        ]
    )
    PARTS[f"{prefix}_coefs"] = f"""
SELECT g, model_type, n, parameter, b, se, {_normal_tail("(b / se)")} AS p,
  b - 1.959963984540054 * se AS lo, b + 1.959963984540054 * se AS hi
FROM {prefix}_params"""
    PARTS[f"{prefix}_effects"] = f"""
SELECT *, dense_rank() OVER (PARTITION BY g, model_type ORDER BY abs(pct) DESC) AS effect_rank,
  CASE WHEN pct < 0 THEN 'csökkenti' WHEN pct > 0 THEN 'növeli' ELSE 'nem változtatja' END AS direction
FROM (SELECT *, (exp(b * 0.01) - 1.0) * 100.0 AS pct FROM {prefix}_coefs WHERE parameter <> 'const')"""
    PARTS[f"{prefix}_metrics"] = f"""
SELECT g, 'log_ols' AS model_type, n, -2.0*llf + 8.0 AS aic, -2.0*llf + 4.0*ln(n) AS bic, 1.0 - ssr/sst AS rsquared,
  1.0 - (n - 1.0) / (n - 4.0) * ssr/sst AS rsquared_adj, CAST(NULL AS DOUBLE) AS deviance,
  CAST(NULL AS DOUBLE) AS null_deviance, CAST(NULL AS DOUBLE) AS pseudo_r2
FROM (SELECT *, -n / 2.0 * (ln(2.0 * pi() * ssr / n) + 1.0) AS llf FROM {prefix}_hc3)
UNION ALL
SELECT g, 'gamma_glm', n, aic, NULL, NULL, NULL, deviance, null_deviance, pseudo_r2 FROM {prefix}_glm_metrics"""


_three_features("pool", "target")
_gamma_steps("pool", 3)
_ols_errors("pool")
_three_features("each", "target || '|' || machine_id")
_gamma_steps("each", 3)
_ols_errors("each")
_one_feature("uni")
_gamma_steps("uni", 1)
_one_feature("each_uni", "target || '|' || machine_id")
_gamma_steps("each_uni", 1)

_TARGET = "split_part(g, '|', 1) AS target"
_MACHINE = "split_part(g, '|', 2) AS machine_id"


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name}"


def _metrics_columns() -> str:
    names = ["aic", "bic", "rsquared", "rsquared_adj", "deviance", "null_deviance", "pseudo_r2"]
    return ", ".join(_r(c, c) for c in names)


_COEF = ", ".join([_r("b", "coefficient"), _r("p", "p_value"), _r("lo", "ci_lower"), _r("hi", "ci_upper")])
_EFFECT = ", ".join(
    [
        "parameter AS feature",
        _r("b", "beta"),
        _r("pct", "estimated_pct_change_for_1pp"),
        "direction",
        _r("p", "p_value"),
        "CAST(effect_rank AS DOUBLE) AS absolute_effect_rank",
    ]
)
_SIGNIFICANT = (
    "parameter AS feature, " + _COEF + ", p < 0.05 AS is_significant, "
    "CASE WHEN b < 0 THEN 'csökkenti' ELSE 'növeli' END AS direction"
)
_FEATURE_CASE = (
    "CASE parameter WHEN 'availability' THEN 'rendelkezésre állás' WHEN 'performance' THEN 'teljesítmény' "
    "WHEN 'quality' THEN 'minőség' END"
)

PARTS["pool_aux"] = """
SELECT g, count(*) AS n, var_pop(e * e) * count(*) AS tss,
  sum((q0 + q1*x1 + q2*x2 + q3*x3 - mean_e2) ** 2) AS ess
FROM (SELECT r.*, q0, q1, q2, q3, avg(e * e) OVER (PARTITION BY r.g) AS mean_e2
      FROM pool_resid r JOIN (SELECT g, sum(a0*e*e) AS q0, sum(a1*e*e) AS q1, sum(a2*e*e) AS q2, sum(a3*e*e) AS q3
                              FROM pool_resid GROUP BY g) q ON q.g = r.g)
GROUP BY g"""
PARTS["pool_bp"] = f"""
SELECT *, {_normal_tail("sqrt(lm)")} + sqrt(2.0 * lm / pi()) * exp(-lm / 2.0) AS lm_p,
  {_f_tail("f", "(n - 4)")} AS f_p
FROM (SELECT g, n, n * ess / tss AS lm, (ess / tss / 3.0) / ((1.0 - ess / tss) / (n - 4)) AS f FROM pool_aux)"""


def _texts(prefix: str) -> None:
    """Feature lists and figures of the Gamma models, one row per group."""
    PARTS[f"{prefix}_lists"] = f"""
SELECT g, list({_FEATURE_CASE} ORDER BY p) FILTER (WHERE p < 0.05) AS sig,
  list({_FEATURE_CASE} ORDER BY p) FILTER (WHERE p >= 0.05) AS nonsig,
  coalesce(list(parameter) FILTER (WHERE p < 0.05), []) AS sig_names,
  arg_min({_FEATURE_CASE}, effect_rank) FILTER (WHERE p < 0.05) AS top,
  arg_min(abs(pct), effect_rank) FILTER (WHERE p < 0.05) AS top_pct
FROM {prefix}_effects WHERE model_type = 'gamma_glm' GROUP BY g"""

    def joined(items: str) -> str:
        return (
            f"CASE WHEN {items} IS NULL THEN '' WHEN len({items}) = 1 THEN {items}[1] "
            f"ELSE array_to_string({items}[1:len({items}) - 1], ', ') || ' és ' || {items}[len({items})] END"
        )

    # Openings and ends of the published sentences.
    primary, secondary = (
        "A teljes rendszerenergia / jó darab mutató esetében a ",
        "A ciklusenergia / jó darab mutató esetében a ",
    )
    one = " a legfontosabb tényező. Ha javul, az energiaintenzitás csökkenhet."
    many = " a legfontosabb tényezők. Ha ezek javulnak, az energiaintenzitás csökkenhet."
    none = "modell most nem mutatott egyértelműen kiemelhető tényezőt."

    def explained(subject: str, rule: str, fixed: str) -> str:
        return (
            f"CASE WHEN {rule} THEN '{subject}{fixed}' WHEN len(sig) = 1 THEN '{subject}' || sig_text || '{one}' "
            f"WHEN len(sig) > 1 THEN '{subject}' || sig_text || '{many}' ELSE '{subject}{none}' END"
        )

    first = explained(
        primary,
        "list_contains(sig_names, 'quality') AND list_contains(sig_names, 'availability')",
        "minőség és a rendelkezésre állás" + many,
    )
    second = explained(secondary, "list_contains(sig_names, 'performance')", "teljesítmény" + one)
    PARTS[f"{prefix}_texts"] = f"""
SELECT l.g, split_part(l.g, '|', 1) AS target_name, m.n, m.pseudo_r2,
  {joined("sig")} AS sig_text, {joined("nonsig")} AS nonsig_text, sig, nonsig, sig_names, top, top_pct
FROM {prefix}_lists l JOIN {prefix}_glm_metrics_n m ON m.g = l.g"""
    PARTS[f"{prefix}_glm_metrics_n"] = f"SELECT * FROM {prefix}_metrics WHERE model_type = 'gamma_glm'"
    PARTS[f"{prefix}_report"] = f"""
SELECT g, CASE WHEN target_name = '{_P}' THEN 'primary' ELSE 'secondary' END AS model_scope,
  CASE WHEN target_name = '{_P}' THEN 1 ELSE 2 END AS display_order, target_name,
  CASE WHEN target_name = '{_P}' THEN 'Teljes rendszerenergia / jó darab' ELSE 'Ciklusenergia / jó darab' END
    AS target_label,
  'Gamma GLM' AS model_type, CAST(n AS INTEGER) AS n_obs, {_r("pseudo_r2", "pseudo_r2")},
  sig_text AS significant_features, nonsig_text AS non_significant_features, '' AS headline,
  CASE WHEN target_name = '{_P}' THEN {first} ELSE {second} END AS explanation,
  'Modell: Gamma GLM. Megfigyelések száma: ' || n || '. Pseudo R²: ' || printf('%.3f', pseudo_r2)
    || '. Szignifikáns tényezők: ' || CASE WHEN sig IS NULL THEN 'nincs' ELSE sig_text END
    || '. Nem szignifikáns tényezők: ' || CASE WHEN nonsig IS NULL THEN 'nincs' ELSE nonsig_text END || '.'
    AS technical_note,
  CASE WHEN sig IS NULL THEN 'A modell alapján most nem emelhető ki egyértelmű szenzitivitási megállapítás.'
    WHEN target_name = '{_P}' THEN 'A főmodell alapján a ' || top || ' javulása 1 százalékponttal várhatóan kb. '
      || printf('%.2f', top_pct) || '%-kal csökkentheti az egy jó darabra jutó teljes rendszerenergia-fogyasztást.'
    ELSE 'A ciklusalapú modell alapján a ' || top || ' javulása 1 százalékponttal várhatóan kb. '
      || printf('%.2f', top_pct) || '%-kal csökkentheti az egy jó darabra jutó ciklusenergia-fogyasztást.'
  END AS sensitivity_message
FROM {prefix}_texts"""


_texts("pool")
_texts("each")

_UNI = f"""
SELECT split_part(g, '|', 1) AS target, split_part(g, '|', 2) AS feature, n, b1 AS b, se,
  {_normal_tail("(b1 / se)")} AS p, b1 - 1.959963984540054 * se AS lo, b1 + 1.959963984540054 * se AS hi,
  (exp(b1 * 0.01) - 1.0) * 100.0 AS pct
FROM (SELECT *, sqrt(scale * c1) AS se FROM uni_glm)"""
PARTS["uni_coefs"] = _UNI
_UNI_COLUMNS = ", ".join(
    [
        "c.target",
        "c.feature",
        _r("b", "beta"),
        _r("p", "p_value"),
        _r("lo", "ci_lower"),
        _r("hi", "ci_upper"),
        _r("pct", "estimated_pct_change_for_1pp"),
        "CASE WHEN pct < 0 THEN 'csökkenti' WHEN pct > 0 THEN 'növeli' ELSE 'nem változtatja' END AS direction",
        _r("aic", "aic"),
    ]
)
_UNI_FROM = "FROM uni_coefs c JOIN uni_glm_metrics m ON m.g = c.target || '|' || c.feature"
_UNI_ALL = (
    f"SELECT {_UNI_COLUMNS}, {_r('deviance', 'deviance')}, {_r('null_deviance', 'null_deviance')}, "
    f"{_r('pseudo_r2', 'pseudo_r2')}, c.n AS n_obs {_UNI_FROM}"
)
_VIF_CELL = {1: "(1.0 - r23 * r23)", 2: "(1.0 - r13 * r13)", 3: "(1.0 - r12 * r12)"}
_CORR = (
    "SELECT target, corr(x1, x2) AS r12, corr(x1, x3) AS r13, corr(x2, x3) AS r23, "
    "corr(x1, y) AS r14, corr(x2, y) AS r24, corr(x3, y) AS r34 FROM mrows GROUP BY target"
)


def _corr_cell(i: int, j: int) -> str:
    return "1.0" if i == j else f"r{min(i, j)}{max(i, j)}"


_VARIABLES = [*_FEATURES, "target_value"]
_VIF = "\nUNION ALL\n".join(
    f"SELECT target, '{name}' AS feature, "
    + _r(f"{_VIF_CELL[i]} / (1.0 + 2.0*r12*r13*r23 - r12*r12 - r13*r13 - r23*r23)", "vif")
    + f" FROM ({_CORR})"
    for i, name in enumerate(_FEATURES, 1)
)
_DASHBOARD = (
    "model_scope, display_order, target_name, target_label, model_type, n_obs, pseudo_r2, significant_features, "
    "non_significant_features, headline, explanation, technical_note, sensitivity_message"
)

QUERIES.update(
    model_dataset="SELECT target, bucket_start, machine_id, y AS target_value, x1 AS availability, "
    "x2 AS performance, x3 AS quality FROM mrows",
    fit_log_ols=f"SELECT g AS target, n AS n_obs, parameter, {_r('b', 'coefficient')}, {_r('se', 'std_err')} "
    "FROM pool_params WHERE model_type = 'log_ols'",
    fit_gamma_glm=f"SELECT p.g AS target, p.n AS n_obs, parameter, {_r('b', 'coefficient')}, {_r('se', 'std_err')}, "
    f"{_r('scale', 'scale')} FROM pool_params p JOIN pool_glm m ON m.g = p.g WHERE model_type = 'gamma_glm'",
    coefficients=f"SELECT g AS target, model_type, parameter, {_COEF} FROM pool_coefs",
    coefficients_by_machine=f"SELECT {_TARGET}, {_MACHINE}, model_type, parameter, {_COEF} FROM each_coefs",
    sensitivity=f"SELECT g AS target, model_type, {_EFFECT} FROM pool_effects",
    sensitivity_rank=f"SELECT {_TARGET}, {_MACHINE}, model_type, {_EFFECT} FROM each_effects",
    model_metrics=f"SELECT g AS target, model_type, n AS n_obs, {_metrics_columns()} FROM pool_metrics",
    stack_models=f"SELECT {_TARGET}, {_MACHINE}, model_type, n AS n_obs, {_metrics_columns()} FROM each_metrics",
    select_model_metrics=f"SELECT {_TARGET}, {_MACHINE}, model_type, n AS n_obs, {_metrics_columns()} "
    f"FROM each_metrics WHERE model_type = 'gamma_glm' AND split_part(g, '|', 1) = '{_P}'",
    vif=_VIF,
    vif_rows=_VIF,
    breusch_pagan=f"SELECT g AS target, {_r('lm', 'lm_stat')}, {_r('lm_p', 'lm_pvalue')}, {_r('f', 'f_stat')}, "
    f"{_r('f_p', 'f_pvalue')} FROM pool_bp",
    correlation_matrix="\nUNION ALL\n".join(
        f"SELECT target, '{name}' AS variable, "
        + ", ".join(_r(_corr_cell(i, j), other) for j, other in enumerate(_VARIABLES, 1))
        + f" FROM ({_CORR})"
        for i, name in enumerate(_VARIABLES, 1)
    ),
    univariate_gamma_glm=_UNI_ALL,
    univariate_order=f"{_UNI_ALL} ORDER BY c.target, p",
    univariate_rows=f"SELECT {_UNI_COLUMNS}, {_r('pseudo_r2', 'pseudo_r2')}, p < 0.05 AS is_significant {_UNI_FROM}",
    significant_coefficients=f"SELECT {_TARGET}, {_MACHINE}, model_type, {_SIGNIFICANT} "
    "FROM each_coefs WHERE parameter <> 'const'",
    rank_significance=f"SELECT {_TARGET}, {_MACHINE}, model_type, {_SIGNIFICANT} "
    "FROM each_coefs WHERE parameter <> 'const' ORDER BY target, machine_id, model_type, is_significant DESC, p",
    sensitivity_rows=f"SELECT {_TARGET}, {_MACHINE}, model_type, {_EFFECT}, p < 0.05 AS is_significant "
    "FROM each_effects",
    top_sensitivity=f"SELECT {_TARGET}, {_MACHINE}, model_type, arg_min(parameter, effect_rank) AS feature, "
    f"{_r('arg_min(pct, effect_rank)', 'estimated_pct_change_for_1pp')}, arg_min(direction, effect_rank) AS direction "
    "FROM each_effects WHERE p < 0.05 GROUP BY g, model_type",
    effects_split=f"SELECT {_TARGET}, {_MACHINE}, model_type, "
    "coalesce(list(parameter ORDER BY effect_rank) FILTER (WHERE p < 0.05), []) AS significant_effects, "
    "coalesce(list(parameter ORDER BY effect_rank) FILTER (WHERE NOT p < 0.05), []) AS non_significant_effects "
    "FROM each_effects WHERE model_type = 'gamma_glm' GROUP BY g, model_type",
    model_explanation=f"SELECT {_MACHINE}, model_scope, explanation FROM each_report",
    sensitivity_message=f"SELECT {_MACHINE}, model_scope, sensitivity_message FROM each_report",
    technical_note=f"SELECT {_MACHINE}, model_scope, technical_note FROM each_report",
    dashboard_rows=f"SELECT {_DASHBOARD} FROM pool_report",
    dashboard_rows_by_machine=f"SELECT {_MACHINE}, {_DASHBOARD} FROM each_report",
    panel_explanations="SELECT CASE model_scope WHEN 'primary' THEN 'Teljes rendszerenergia / jó darab (Gamma GLM)' "
    "ELSE 'Ciklusenergia / jó darab (Gamma GLM)' END AS \"Célváltozó\", explanation AS \"Magyarázat\" "
    "FROM pool_report ORDER BY display_order",
    panel_sensitivities="SELECT CASE model_scope WHEN 'primary' THEN 'Teljes rendszerenergia / jó darab' "
    "ELSE 'Ciklusenergia / jó darab' END AS \"Elemzés\", sensitivity_message AS \"Megállapítás\" "
    "FROM pool_report ORDER BY display_order",
    upsert_dashboard=f"SELECT {_DASHBOARD} FROM pool_report",
    dq_check_model_scope="SELECT 'model_scope' AS rule, 'regression_dashboard_summary' AS \"table\", "
    "machine_id || ':' || model_scope AS key, machine_id || ':' || model_scope AS detail "
    f"FROM (SELECT {_MACHINE}, model_scope FROM each_report) WHERE right(machine_id, 1) IN ('1', '3', '5', '7', '9')",
    model_status="SELECT target, machine_id, model_type, count(*) AS n_obs, "
    "CASE WHEN count(*) >= 10 THEN 'ok' ELSE 'too_few_rows' END AS status "
    "FROM mrows, (VALUES ('log_ols'), ('gamma_glm')) AS m(model_type) GROUP BY ALL",
)

# --- nested and exported results, cell by cell -------------------------------------


def _cells(head: str, figures: dict[str, str], texts: dict[str, str], source: str) -> list[str]:
    """One SELECT per cell: the columns of `head`, then name, value, text."""
    return [
        f"SELECT {head}, '{n}' AS name, round(CAST({x} AS DOUBLE), 6) + 0.0 AS value, CAST(NULL AS VARCHAR) AS text FROM {source}"
        for n, x in figures.items()
    ] + [
        f"SELECT {head}, '{n}' AS name, CAST(NULL AS DOUBLE) AS value, CAST({x} AS VARCHAR) AS text FROM {source}"
        for n, x in texts.items()
    ]


def _place(order: str, group: str = "g") -> str:
    return f"row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1 AS position"


_TWO_WORDS = "CASE WHEN b < 0 THEN 'csökkenti' ELSE 'növeli' END"
_THREE_WORDS = "CASE WHEN pct < 0 THEN 'csökkenti' WHEN pct > 0 THEN 'növeli' ELSE 'nem változtatja' END"
_BOUNDS = {"p_value": "p", "ci_lower": "lo", "ci_upper": "hi"}
_FIGURES = ["aic", "bic", "rsquared", "rsquared_adj", "deviance", "null_deviance", "pseudo_r2"]
_UNI_JOINED = f"(SELECT c.*, m.aic, m.pseudo_r2, m.deviance, m.null_deviance {_UNI_FROM})"
_VIF_ROWS = f"({_VIF})"
# The same per machine; g begins with target and machine.
PARTS["each_uni_coefs"] = f"""
SELECT g, split_part(g, '|', 3) AS feature, n, b1 AS b, se, {_normal_tail("(b1 / se)")} AS p,
  b1 - 1.959963984540054 * se AS lo, b1 + 1.959963984540054 * se AS hi, (exp(b1 * 0.01) - 1.0) * 100.0 AS pct
FROM (SELECT *, sqrt(scale * c1) AS se FROM each_uni_glm)"""
_EACH_UNI_JOINED = "(SELECT c.*, m.aic, m.pseudo_r2 FROM each_uni_coefs c JOIN each_uni_glm_metrics m ON m.g = c.g)"
_EACH_VIF_ROWS = "({})".format(
    _VIF.replace("SELECT target, '", "SELECT target || '|' || machine_id AS g, '")
    .replace("SELECT target, corr", "SELECT target, machine_id, corr")
    .replace("GROUP BY target", "GROUP BY target, machine_id")
)


def _documents(by_machine: bool = False) -> str:
    fits = "each" if by_machine else "pool"
    uni, group = (_EACH_UNI_JOINED, "split_part(g, '|', 1), split_part(g, '|', 2)") if by_machine else (_UNI_JOINED, "target")
    vif, vif_group = (_EACH_VIF_ROWS, "g") if by_machine else (_VIF_ROWS, "target")

    def head(section: str) -> str:
        if by_machine:
            return f"{_TARGET}, {_MACHINE}, '{section}' AS section, position"
        target = "target" if section in ("univariate_gamma_glm", "vif") else "g AS target"
        return f"{target}, '{section}' AS section, position"

    sections = [
        (
            "metrics",
            {"n_obs": "n", **{c: c for c in _FIGURES}},
            {"model_type": "model_type"},
            f"(SELECT *, 0 AS position FROM {fits}_metrics WHERE model_type = 'gamma_glm')",
        ),
        (
            "significant_coefficients",
            {"coefficient": "b", **_BOUNDS},
            {"feature": "parameter", "is_significant": "p < 0.05", "direction": _TWO_WORDS},
            f"(SELECT *, {_place('p >= 0.05, p')} FROM {fits}_coefs WHERE model_type = 'gamma_glm' AND parameter <> 'const')",
        ),
        (
            "sensitivity",
            {"beta": "b", "estimated_pct_change_for_1pp": "pct", "p_value": "p", "absolute_effect_rank": "effect_rank"},
            {"feature": "parameter", "direction": "direction", "is_significant": "p < 0.05"},
            f"(SELECT *, {_place('effect_rank')} FROM {fits}_effects WHERE model_type = 'gamma_glm')",
        ),
        (
            "univariate_gamma_glm",
            {"beta": "b", **_BOUNDS, "estimated_pct_change_for_1pp": "pct", "aic": "aic", "pseudo_r2": "pseudo_r2"},
            {"feature": "feature", "direction": _THREE_WORDS, "is_significant": "p < 0.05"},
            f"(SELECT *, {_place('p', group)} FROM {uni})",
        ),
        ("vif", {"vif": "vif"}, {"feature": "feature"}, f"(SELECT *, {_place('feature', vif_group)} FROM {vif})"),
    ]
    return "\nUNION ALL\n".join(
        cell for name, figures, texts, source in sections for cell in _cells(head(name), figures, texts, source)
    )


def _exports() -> str:
    """The cells of every exported table; its texts and times are the key."""
    correlation = [
        f"(SELECT target, '{name}' AS variable, "
        + ", ".join(f"{_corr_cell(i, j)} AS {other}" for j, other in enumerate(_VARIABLES, 1))
        + f" FROM ({_CORR}))"
        for i, name in enumerate(_VARIABLES, 1)
    ]
    tables = [
        (
            "model_dataset",
            ["target", "bucket_start", "machine_id"],
            {"target_value": "y", "availability": "x1", "performance": "x2", "quality": "x3"},
            "mrows",
        ),
        ("coefficients", ["g", "model_type", "parameter"], {"coefficient": "b", **_BOUNDS}, "pool_coefs"),
        (
            "sensitivity",
            ["g", "model_type", "parameter", "direction"],
            {"beta": "b", "estimated_pct_change_for_1pp": "pct", "p_value": "p", "absolute_effect_rank": "effect_rank"},
            "pool_effects",
        ),
        ("model_metrics", ["g", "model_type"], {"n_obs": "n", **{c: c for c in _FIGURES}}, "pool_metrics"),
        ("vif", ["target", "feature"], {"vif": "vif"}, _VIF_ROWS),
        ("breusch_pagan", ["g"], {"lm_stat": "lm", "lm_pvalue": "lm_p", "f_stat": "f", "f_pvalue": "f_p"}, "pool_bp"),
        *[("correlation_matrix", ["target", "variable"], {v: v for v in _VARIABLES}, source) for source in correlation],
        (
            "univariate_gamma_glm",
            ["target", "feature", f"({_THREE_WORDS})"],
            {
                "beta": "b",
                **_BOUNDS,
                "estimated_pct_change_for_1pp": "pct",
                **{c: c for c in ("aic", "deviance", "null_deviance", "pseudo_r2")},
                "n_obs": "n",
            },
            _UNI_JOINED,
        ),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}) AS key, "
        f"'{name}' AS name, round(CAST({x} AS DOUBLE), {9 if table == 'model_dataset' else 6}) + 0.0 AS value FROM {source}"
        for table, keys, figures, source in tables
        for name, x in figures.items()
    )


QUERIES.update(regression_summary=_documents(), scan_summary_json=_documents(), export_model_outputs=_exports(), run_targets=_exports())
QUERIES.update(regression_summary_by_machine=_documents(True), scan_summary_json_by_machine=_documents(True))


def _cells(section: str, query: str, named: str, columns: list[str], where: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT target, '{section}' AS section, {named} || '{column}' AS name, CAST({column} AS DOUBLE) AS value "
        f"FROM ({QUERIES[query]}) {where}"
        for column in columns
    )


QUERIES["fit_from_moments"] = " UNION ALL ".join(
    [
        _cells("coefficients", "fit_log_ols", "parameter || '.'", ["coefficient"]),
        _cells("metrics", "model_metrics", "''", ["n_obs", "aic", "bic", "rsquared", "rsquared_adj"], "WHERE model_type = 'log_ols'"),
        _cells("vif", "vif", "feature || '.'", ["vif"]),
        _cells("correlation", "correlation_matrix", "variable || '.'", [*_VARIABLES]),
    ]
)
