"""Published report rows and summary documents from regression result tables.

Every function works on the rows of all models at once; arrays inside a row
hold one entry per feature, so they stay as small as a model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import constants as k

BY = ("target",)


# --- row sets -------------------------------------------------------------------


def _null_if_nan(name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name)).alias(name)


def select_model_metrics(
    metrics: DataFrame, target: str | None = None, model_type: str | None = None
) -> DataFrame:
    """Metric rows of a target and model type (all when not given), NaN as NULL."""
    if target is not None:
        metrics = metrics.filter(F.col("target") == target)
    if model_type is not None:
        metrics = metrics.filter(F.col("model_type") == model_type)
    doubles = {name for name, kind in metrics.dtypes if kind == "double"}
    return metrics.select(*[_null_if_nan(c) if c in doubles else F.col(c) for c in metrics.columns])


def with_significance(df: DataFrame, alpha: float = k.SIGNIFICANCE_LEVEL) -> DataFrame:
    significant = F.coalesce((F.col("p_value") < alpha) & ~F.isnan("p_value"), F.lit(False))
    return df.withColumn("is_significant", significant)


def significant_coefficients(coefs: DataFrame, alpha: float = k.SIGNIFICANCE_LEVEL) -> DataFrame:
    """Feature coefficients flagged; the direction has two words, zero counts as growth."""
    return with_significance(coefs.filter(F.col("parameter") != "const"), alpha).select(
        *[c for c in coefs.columns if c not in ("parameter", "coefficient", "p_value", "ci_lower", "ci_upper")],
        F.col("parameter").alias("feature"),
        "coefficient",
        "p_value",
        "ci_lower",
        "ci_upper",
        "is_significant",
        F.when(F.col("coefficient") < 0, k.DECREASES).otherwise(k.INCREASES).alias("direction"),
    )


def rank_significance(rows: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Significant features first, then by p-value."""
    return rows.orderBy(*by, "model_type", F.desc("is_significant"), "p_value")


def sensitivity_rows(sensitivity: DataFrame, alpha: float = k.SIGNIFICANCE_LEVEL) -> DataFrame:
    return with_significance(sensitivity, alpha)


def univariate_rows(univariate: DataFrame, alpha: float = k.SIGNIFICANCE_LEVEL) -> DataFrame:
    return with_significance(univariate.drop("deviance", "null_deviance", "n_obs"), alpha)


def vif_rows(vif: DataFrame) -> DataFrame:
    return vif.select(*[c for c in vif.columns if c != "vif"], _null_if_nan("vif"))


def top_sensitivity(rows: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """The significant feature with the largest effect of each model."""
    top = F.min_by(F.struct("feature", "estimated_pct_change_for_1pp", "direction"), "absolute_effect_rank")
    return (
        rows.filter("is_significant")
        .groupBy(*by, "model_type")
        .agg(top.alias("_top"))
        .select(*by, "model_type", "_top.*")
    )


# --- one row per model --------------------------------------------------------------


def _collected(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], fields: Sequence[str], name: str) -> DataFrame:
    """All feature rows of a model as one ordered array of structs."""
    ordered = F.struct(
        *[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*fields).alias("row")
    )
    return rows.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(ordered)), lambda s: s["row"]).alias(name)
    )


# The fields of the published summary, in their order.
_COEFFICIENT_FIELDS = ["feature", "coefficient", "p_value", "ci_lower", "ci_upper", "is_significant", "direction"]
_SENSITIVITY_FIELDS = [
    "feature",
    "beta",
    "estimated_pct_change_for_1pp",
    "direction",
    "p_value",
    "absolute_effect_rank",
    "is_significant",
]
_UNIVARIATE_FIELDS = [
    "feature",
    "beta",
    "p_value",
    "ci_lower",
    "ci_upper",
    "estimated_pct_change_for_1pp",
    "direction",
    "aic",
    "pseudo_r2",
    "is_significant",
]
_METRIC_FIELDS = [
    "target",
    "model_type",
    "n_obs",
    "aic",
    "bic",
    "rsquared",
    "rsquared_adj",
    "deviance",
    "null_deviance",
    "pseudo_r2",
]


def model_documents(
    metrics: DataFrame,
    coefs: DataFrame,
    sensitivity: DataFrame,
    by: Sequence[str] = BY,
    model_type: str = k.GAMMA_GLM,
    alpha: float = k.SIGNIFICANCE_LEVEL,
) -> DataFrame:
    """One row per model: metrics, ordered coefficients and sensitivities."""
    keys = [*by, "model_type"]
    not_significant = ~F.col("is_significant")
    chosen = F.col("model_type") == model_type
    metric_rows = select_model_metrics(metrics.filter(chosen)).select(
        *keys, F.struct(*_METRIC_FIELDS).alias("metrics")
    )
    coefficient_rows = _collected(
        significant_coefficients(coefs.filter(chosen), alpha),
        keys,
        [not_significant, F.col("p_value")],
        _COEFFICIENT_FIELDS,
        "significant_coefficients",
    )
    effect_rows = _collected(
        sensitivity_rows(sensitivity.filter(chosen), alpha),
        keys,
        [F.col("absolute_effect_rank")],
        _SENSITIVITY_FIELDS,
        "sensitivity",
    )
    return metric_rows.join(coefficient_rows, keys).join(effect_rows, keys)


def regression_summary(
    documents: DataFrame, univariate: DataFrame, vif: DataFrame, by: Sequence[str] = BY
) -> DataFrame:
    """The nested summary: one document per model with all its row sets."""
    univariate_sets = _collected(
        univariate_rows(univariate), by, [F.col("p_value")], _UNIVARIATE_FIELDS, "univariate_gamma_glm"
    )
    vif_sets = _collected(vif_rows(vif), by, [F.col("feature")], ["feature", "vif"], "vif")
    return (
        documents.join(univariate_sets, list(by), "left")
        .join(vif_sets, list(by), "left")
        .withColumn("significance_level", F.lit(k.SIGNIFICANCE_LEVEL))
    )


def effects_split(documents: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Sensitivities split into significant and other effects."""
    return documents.select(
        *by,
        "model_type",
        F.filter("sensitivity", lambda r: r["is_significant"]).alias("significant_effects"),
        F.filter("sensitivity", lambda r: ~r["is_significant"]).alias("non_significant_effects"),
    )


# --- texts -----------------------------------------------------------------------------


def _label(value: Column, labels: dict[str, str]) -> Column:
    out = value
    for name, label in labels.items():
        out = F.when(value == name, label).otherwise(out)
    return out


def features_where(significant: bool) -> Column:
    """Feature names of a document, in its order."""
    wanted = F.filter(
        "significant_coefficients", lambda r: r["is_significant"] if significant else ~r["is_significant"]
    )
    return F.transform(wanted, lambda r: r["feature"])


def labelled(features: Column) -> Column:
    return F.transform(features, lambda f: _label(f, k.FEATURE_LABELS))


def listed(items: Column) -> Column:
    """'a, b és c'."""
    count = F.size(items)
    head = F.concat_ws(", ", F.slice(items, F.lit(1), F.greatest(count - 1, F.lit(0))))
    return (
        F.when(count == 0, "")
        .when(count == 1, F.get(items, F.lit(0)))
        .otherwise(F.concat(head, F.lit(k.LIST_JOINER), F.get(items, count - 1)))
    )


def model_explanation(scope: str, significant: Column) -> Column:
    """Which features matter, in a sentence: a fixed rule first, then by number of features."""
    rule = F.lit(True)
    for feature in k.EXPLANATION_RULE_FEATURES[scope]:
        rule = rule & F.array_contains(significant, feature)
    names = listed(labelled(significant))
    return (
        F.when(rule, k.EXPLANATION_RULE[scope])
        .when(F.size(significant) == 1, F.format_string(k.EXPLANATION_ONE[scope], names))
        .when(F.size(significant) > 1, F.format_string(k.EXPLANATION_MANY[scope], names))
        .otherwise(k.EXPLANATION_NONE[scope])
    )


def sensitivity_message() -> Column:
    """The largest significant effect in a sentence; it always speaks of a decrease."""
    significant = F.filter("sensitivity", lambda r: r["is_significant"])
    top = F.get(significant, F.lit(0))
    feature = _label(top["feature"], k.FEATURE_LABELS)
    size = F.abs(top["estimated_pct_change_for_1pp"])
    return (
        F.when(F.size(significant) == 0, k.SENSITIVITY_NONE)
        .when(F.col("target") == k.PRIMARY_TARGET, F.format_string(k.SENSITIVITY_PRIMARY, feature, size))
        .when(F.col("target") == k.SECONDARY_TARGET, F.format_string(k.SENSITIVITY_SECONDARY, feature, size))
        .otherwise(F.format_string(k.SENSITIVITY_OTHER, feature, size))
    )


def technical_note(significant: Column, other: Column) -> Column:
    def named(features: Column) -> Column:
        return F.when(F.size(features) == 0, k.NO_FEATURES).otherwise(listed(labelled(features)))

    r2 = F.col("metrics.pseudo_r2")
    return F.format_string(
        k.TECHNICAL_NOTE,
        _label(F.col("model_type"), k.MODEL_LABELS),
        F.col("metrics.n_obs").cast("string"),
        F.when(r2.isNull(), k.NOT_AVAILABLE).otherwise(F.format_string("%.3f", r2)),
        named(significant),
        named(other),
    )


def dashboard_rows(documents: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """The published row of each model: scope, labels, figures and the three texts."""
    scope = F.lit("secondary")
    order = F.lit(k.SCOPE_ORDER["secondary"])
    for name, target in k.SCOPE_TARGETS.items():
        scope = F.when(F.col("target") == target, name).otherwise(scope)
        order = F.when(F.col("target") == target, k.SCOPE_ORDER[name]).otherwise(order)
    significant, other = features_where(True), features_where(False)
    explanation = F.when(F.col("model_scope") == "primary", model_explanation("primary", significant)).otherwise(
        model_explanation("secondary", significant)
    )
    groups = [c for c in by if c != "target"]
    return documents.withColumn("model_scope", scope).select(
        *groups,
        "model_scope",
        order.cast("smallint").alias("display_order"),
        F.col("target").alias("target_name"),
        _label(F.col("target"), k.TARGET_LABELS).alias("target_label"),
        _label(F.col("model_type"), k.MODEL_LABELS).alias("model_type"),
        F.col("metrics.n_obs").cast("int").alias("n_obs"),
        F.col("metrics.pseudo_r2").alias("pseudo_r2"),
        listed(labelled(significant)).alias("significant_features"),
        listed(labelled(other)).alias("non_significant_features"),
        F.lit("").alias("headline"),
        explanation.alias("explanation"),
        technical_note(significant, other).alias("technical_note"),
        sensitivity_message().alias("sensitivity_message"),
    )
