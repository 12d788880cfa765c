"""The eight dashboard queries.

`lo` and `hi` are both inclusive, as a dashboard time picker gives them. On
stored hourly tables the range filter prunes date partitions (see
`sources.store.read_published_range`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import constants as k
from wattline.functions.timeline import hour_start

TIME = "time"
GOOD_LABEL, SCRAP_LABEL, ENERGY_LABEL = "Jó darab", "Selejt darab", "Összes energia"


def in_range(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    kind = df.schema[ts].dataType
    return df.filter(F.col(ts).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))


def _labelled(column: str, labels: dict[str, str], default: Column | None = None) -> Column:
    out = default if default is not None else F.lit(None).cast("string")
    for value, label in labels.items():
        out = F.when(F.col(column) == value, label).otherwise(out)
    return out


def _rounded_means(df: DataFrame, names: list[str]) -> DataFrame:
    return df.agg(*[F.round(F.avg(n), 3).alias(n) for n in names])


def oee_gauge(oee_hourly: DataFrame, lo: str, hi: str) -> DataFrame:
    return _rounded_means(
        in_range(oee_hourly, "bucket_start", lo, hi), ["oee", "availability", "performance", "quality"]
    )


def energy_intensity(oee_hourly: DataFrame, lo: str, hi: str) -> DataFrame:
    return _rounded_means(
        in_range(oee_hourly, "bucket_start", lo, hi),
        [
            "energy_per_part_kwh",
            "cycle_energy_per_good_part_kwh",
            "energy_per_scrap_part_kwh",
            "system_energy_per_good_part_kwh",
        ],
    )


def state_share(detailed_hourly: DataFrame, lo: str, hi: str) -> DataFrame:
    """Energy per state label, largest first."""
    label = _labelled("detailed_state_code", k.STATE_LABELS, F.col("detailed_state_code"))
    energy = F.sum(F.col("energy_kwh").cast("decimal(28,6)"))
    return (
        in_range(detailed_hourly, "bucket_start", lo, hi)
        .groupBy(label.alias("allapot"))
        .agg(F.round(energy, 3).cast("double").alias("energia_kwh"))
        .orderBy(F.desc("energia_kwh"))
    )


def state_timeseries(detailed_hourly: DataFrame, lo: str, hi: str) -> DataFrame:
    return (
        in_range(detailed_hourly, "bucket_start", lo, hi)
        .select(F.col("bucket_start").alias(TIME), F.col("detailed_state_code").alias("metric"), "energy_kwh")
        .orderBy(TIME, "metric")
    )


def category_timeseries(energy_hourly: DataFrame, lo: str, hi: str) -> DataFrame:
    return (
        in_range(energy_hourly, "bucket_start", lo, hi)
        .select(
            F.col("bucket_start").alias(TIME),
            F.col("energy_productive_kwh").alias("Termelő energia"),
            F.col("energy_non_productive_kwh").alias("Nem termelő energia"),
            F.col("energy_non_productive_stop_kwh").alias("Nem termelő és áll energia"),
        )
        .orderBy(TIME)
    )


def parts_energy_full_outer(cycles: DataFrame, energy_hourly: DataFrame, lo: str, hi: str) -> DataFrame:
    """Parts by the hour in which the cycle ended, beside the energy of that hour; both sides are kept."""
    parts = (
        in_range(cycles, "cycle_end_ts", lo, hi)
        .groupBy(hour_start(cycles, "cycle_end_ts").alias(TIME))
        .agg(
            F.count_if(F.col("part_result") == k.RESULT_GOOD).alias(GOOD_LABEL),
            F.count_if(F.col("part_result") == k.RESULT_SCRAP).alias(SCRAP_LABEL),
        )
    )
    energy = (
        in_range(energy_hourly, "bucket_start", lo, hi)
        .groupBy(F.col("bucket_start").alias(TIME))
        .agg(F.sum(F.col("energy_total_kwh").cast("decimal(28,6)")).cast("double").alias(ENERGY_LABEL))
    )
    return parts.join(energy, TIME, "full_outer")


def parts_vs_energy(cycles: DataFrame, energy_hourly: DataFrame, lo: str, hi: str) -> DataFrame:
    joined = parts_energy_full_outer(cycles, energy_hourly, lo, hi)
    return joined.select(
        TIME,
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in (GOOD_LABEL, SCRAP_LABEL)],
        F.coalesce(ENERGY_LABEL, F.lit(0.0)).alias(ENERGY_LABEL),
    ).orderBy(TIME)


def explanations(dashboard: DataFrame) -> DataFrame:
    return dashboard.orderBy("display_order").select(
        _labelled("model_scope", k.EXPLANATION_PANEL_LABELS).alias("Célváltozó"),
        F.col("explanation").alias("Magyarázat"),
    )


def sensitivities(dashboard: DataFrame) -> DataFrame:
    return dashboard.orderBy("display_order").select(
        _labelled("model_scope", k.SENSITIVITY_PANEL_LABELS).alias("Elemzés"),
        F.col("sensitivity_message").alias("Megállapítás"),
    )
