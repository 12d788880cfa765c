"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query starts from the stored input tables (derived from all rows of the
test tables). What a system would keep between its jobs is stored once per
application and input folder: the input tables, the published tables that the
panels read, the 4-hour regression input, and the pooled and per-machine fits
that the result and report queries read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattline import schemas
from wattline.functions import constants as k
from wattline.operators import moments, quality
from wattline.operators import regression as reg
from wattline.plans import enrich, incremental, kpi, panels, report
from wattline.plans.regression import RegressionRun, run_targets
from wattline.session import cut_lineage, pin_utc, scratch_path
from wattline.sources import derived, readers, seed_csv, sinks, store
from wattline.streaming import enriched as streamed
from wattline.streaming import hourly, published

Query = Callable[[SparkSession, str], DataFrame]
#: Of the month of test data, the days that the panels show; both ends are hours with data and inclusive.
LO, HI = "2024-01-08 05:00:00", "2024-01-22 17:00:00"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, so that both engines compare the same types."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


_STAGES: dict[tuple, object] = {}


def _stage(spark: SparkSession, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, derived.input_state(spark, sf_dir), name)
    if key not in _STAGES:
        _STAGES[key] = build()
    return _STAGES[key]


class Plant:
    """The input tables of one scale and the frames built on them, all lazy."""

    #: What supplies the input tables.
    _source = staticmethod(derived.stored_tables)

    def __init__(self, spark: SparkSession, sf_dir: str):
        tables = self._source(pin_utc(spark), sf_dir)
        self.tables = tables
        self.machine = tables["machine"]
        self.operation = tables["operation"]
        self.states = tables["machine_state_event"]
        self.cycles = tables["cycle_event"]
        self.samples = tables["energy_measurement"]

    @cached_property
    def by_hour(self) -> DataFrame:
        return enrich.enriched_by_hour(self.samples, self.states, self.cycles)

    @property
    def enriched(self) -> DataFrame:
        return enrich.energy_enriched(self.samples, self.states, self.cycles)

    @cached_property
    def cube(self) -> DataFrame:
        """Written when first used: queries that need several views read the samples once."""
        return cut_lineage(kpi.energy_cube(self.by_hour), "energy_cube")

    @property
    def summary(self) -> DataFrame:
        return enrich.cycle_energy_summary(self.cycles, self.cube)

    @property
    def energy_hourly(self) -> DataFrame:
        return kpi.state_energy_summary_hourly(self.cube)

    @property
    def detailed_hourly(self) -> DataFrame:
        return kpi.detailed_from_cube(self.cube)

    @cached_property
    def bounds(self) -> DataFrame:
        return kpi.machine_time_bounds(self.machine, self.samples, self.states, self.cycles)

    @property
    def intervals(self) -> DataFrame:
        return kpi.state_intervals(self.states, self.bounds)

    @property
    def bucketed(self) -> DataFrame:
        return kpi.state_interval_bucketed(self.intervals)

    @property
    def state_time(self) -> DataFrame:
        return kpi.state_time_hourly(self.bucketed)

    @property
    def cycle_stats(self) -> DataFrame:
        return kpi.cycle_stats_of(enrich.cycles_with_energy(self.cycles, self.cube), self.operation)

    @property
    def hourly(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.energy_hourly, self.state_time, self.cycle_stats

    @property
    def oee(self) -> DataFrame:
        return kpi.oee_energy_summary_hourly(*self.hourly)

    @property
    def base(self) -> DataFrame:
        return kpi.regression_base_hourly(*self.hourly)

    @property
    def regression_input(self) -> DataFrame:
        return kpi.aggregate_regression_input(self.base)

    @property
    def totals(self) -> DataFrame:
        totals = kpi.kpi_totals(self.cube, self.summary)
        return totals.withColumn("cycle_energy_stddev_kwh", F.round("cycle_energy_stddev_kwh", 6))


class RawPlant(Plant):
    """The uncleaned feed; its derived tables carry the defects on."""

    _source = staticmethod(derived.stored_raw_feed)

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._stored = lambda name, build: _stage(spark, sf_dir, f"raw_{name}", lambda: cut_lineage(build(), name))

    @cached_property
    def enriched(self) -> DataFrame:
        """Stored, as the table that the rules look at."""
        inputs = self.samples, self.states, self.cycles
        return self._stored("energy_enriched", lambda: enrich.energy_enriched(*inputs))

    @cached_property
    def summary(self) -> DataFrame:
        """Cycles whose id names one cycle; energy of a repeated id could not be told apart."""
        repeated = self.cycles.groupBy("cycle_id").agg(F.count("*").alias("n")).filter("n > 1")
        single = self.cycles.join(repeated.select("cycle_id"), "cycle_id", "left_anti")
        return self._stored("cycle_energy_summary", lambda: enrich.cycle_energy_summary(single, self.enriched))

    @property
    def all_tables(self) -> dict[str, DataFrame]:
        return {**self.tables, "energy_enriched": self.enriched, "cycle_energy_summary": self.summary}


def _on(view: Callable[[Plant], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(view(Plant(spark, sf_dir)))


def _raw(view: Callable[[RawPlant], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(view(RawPlant(spark, sf_dir)))


ALIGNMENT: dict[str, Query] = {
    "lag_counter": _on(lambda p: enrich.lag_counter(p.samples)),
    "delta_energy": _on(lambda p: enrich.delta_energy(p.samples)),
    "asof_state_join": _on(lambda p: enrich.asof_state_join(p.samples, p.states)),
    "interval_cycle_join": _on(lambda p: enrich.interval_cycle_join(p.samples, p.cycles)),
    "interval_overlapping_cycle_join": lambda spark, sf_dir: enrich.interval_cycle_join(
        Plant(spark, sf_dir).samples, RawPlant(spark, sf_dir).cycles
    ),
    "energy_enriched": _on(lambda p: p.enriched),
    "cycle_energy_join": _on(lambda p: enrich.cycle_energy_join(p.cycles, p.by_hour)),
    "cycle_energy_summary": _on(lambda p: enrich.cycle_energy_summary(p.cycles, p.by_hour)),
    "preview_enriched": _on(lambda p: enrich.preview_enriched(p.enriched)),
    "preview_cycles": _on(lambda p: enrich.preview_cycles(enrich.cycle_energy_summary(p.cycles, p.by_hour))),
    "row_counts": lambda spark, sf_dir: _row_counts(pin_utc(spark), sf_dir),
}

HOURLY: dict[str, Query] = {
    "state_energy_summary_hourly": _on(lambda p: kpi.state_energy_summary_hourly(p.by_hour)),
    "detailed_state_energy_summary_hourly": _on(lambda p: kpi.detailed_state_energy_summary_hourly(p.by_hour)),
    "energy_cube": _on(lambda p: kpi.energy_cube(p.by_hour)),
    "all_machines": _on(lambda p: kpi.all_machines(p.machine, p.samples, p.states, p.cycles)),
    "machine_time_bounds": _on(lambda p: p.bounds),
    "bounds_join": _on(lambda p: kpi.bounds_join(p.states, p.bounds)),
    "state_intervals": _on(lambda p: p.intervals),
    "lateral_hours": _on(lambda p: kpi.lateral_hours(p.intervals)),
    "state_interval_bucketed": _on(lambda p: p.bucketed),
    "state_time_hourly": _on(lambda p: p.state_time),
    "cycle_operation_join": _on(lambda p: kpi.cycle_operation_join(p.cycles, p.operation)),
    "cycle_summary_left_join": _on(lambda p: kpi.cycle_summary_left_join(p.cycles, p.summary)),
    "cycle_stats_hourly": _on(lambda p: p.cycle_stats),
    "all_buckets": _on(lambda p: kpi.all_buckets(*p.hourly)),
    "spine_left_joins": _on(lambda p: kpi.spine_left_joins(*p.hourly)),
    "oee_energy_summary_hourly": _on(lambda p: p.oee),
    "regression_base_hourly": _on(lambda p: p.base),
    "regression_input_4h": _on(lambda p: p.regression_input),
    "target_profile": _on(
        lambda p: kpi.target_profile(p.regression_input).withColumn("mean_value", F.round("mean_value", 6))
    ),
    "kpi_cross_join": _on(
        lambda p: kpi.kpi_cross_join(p.cube, p.summary).withColumn(
            "cycle_energy_stddev_kwh", F.round("cycle_energy_stddev_kwh", 6)
        )
    ),
    "kpi_totals": _on(lambda p: p.totals),
    "kpi_invariants": _on(lambda p: quality.kpi_invariants(p.totals)),
}

def _publish_all(spark: SparkSession, plant: Plant, out_dir: str) -> None:
    """Base, derived and hourly tables of one input."""
    sinks.full_refresh(spark, plant.tables, out_dir, quality.primary_keys)
    sinks.rebuild_enriched(spark, plant.tables, out_dir)
    stored = {**plant.tables, "energy_enriched": store.read_table(spark, out_dir, "energy_enriched")}
    sinks.publish_hourly(spark, stored, out_dir)


def _published(spark: SparkSession, sf_dir: str) -> str:
    """The folder of all published tables of one input."""

    def build() -> str:
        out_dir = scratch_path(spark, "plant")
        _publish_all(spark, Plant(spark, sf_dir), out_dir)
        return out_dir

    return _stage(pin_utc(spark), sf_dir, "published", build)


def _shown(panel: Callable[..., DataFrame], *tables: str) -> Query:
    """A panel over the shown days of published tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out_dir = _published(spark, sf_dir)
        return plain(panel(*[store.read_published_range(spark, out_dir, t, LO, HI) for t in tables], LO, HI))

    return run


PANELS: dict[str, Query] = {
    "panel_oee_gauge": _shown(panels.oee_gauge, "oee_energy_summary_hourly"),
    "panel_energy_intensity": _shown(panels.energy_intensity, "oee_energy_summary_hourly"),
    "panel_state_share": _shown(panels.state_share, "detailed_state_energy_summary_hourly"),
    "panel_state_timeseries": _shown(panels.state_timeseries, "detailed_state_energy_summary_hourly"),
    "panel_category_timeseries": _shown(panels.category_timeseries, "state_energy_summary_hourly"),
    "parts_energy_full_outer": _shown(panels.parts_energy_full_outer, "cycle_event", "state_energy_summary_hourly"),
    "panel_parts_vs_energy": _shown(panels.parts_vs_energy, "cycle_event", "state_energy_summary_hourly"),
}

QUALITY: dict[str, Query] = {
    "dq_primary_keys": lambda spark, sf_dir: quality.primary_keys(_with_dashboard(spark, sf_dir)),
    "dq_foreign_keys": _raw(lambda p: quality.foreign_keys(p.all_tables)),
    "dq_not_null": lambda spark, sf_dir: quality.not_null(_with_dashboard(spark, sf_dir)),
    "dq_decimal_range": _raw(lambda p: quality.decimal_range(p.all_tables)),
    "dq_check_operation_ideal": _raw(lambda p: quality.check_operation_ideal(p.operation)),
    "dq_check_power": _raw(lambda p: quality.check_power(p.samples)),
    "dq_check_sample_interval": _raw(lambda p: quality.check_sample_interval(p.samples)),
    "dq_check_cycle_order": _raw(lambda p: quality.check_cycle_order(p.cycles)),
    "dq_check_cycle_time": _raw(lambda p: quality.check_cycle_time(p.cycles)),
    "dq_check_part_result": _raw(lambda p: quality.check_part_result(p.cycles, p.summary)),
    "dq_check_summary_order": _raw(lambda p: quality.check_summary_order(p.summary)),
    "dq_check_summary_energy": _raw(lambda p: quality.check_summary_energy(p.summary)),
    "dq_overlapping_cycles": _raw(lambda p: quality.overlapping_cycles(p.cycles)),
}


def _with_dashboard(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw tables and a dashboard table in which scopes, orders and texts are not as they should be.

    The rows of all machines share two scopes and orders; every other machine lacks its headline.
    """
    tables = RawPlant(spark, sf_dir).all_tables
    odd = F.substring("machine_id", -1, 1).isin("1", "3", "5", "7", "9")
    rows = _dashboard(_each(spark, sf_dir)).withColumn("headline", F.when(~odd, F.col("headline")))
    dashboard = rows.withColumn("updated_at", F.current_timestamp())
    return {**tables, "regression_dashboard_summary": dashboard}


# --- regression and report ------------------------------------------------------
#
# The stages hand stored tables to each other: the 4-hour input is written once
# per application, and so are the fits of the pooled and of the per-machine run.

def _input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage(
        spark, sf_dir, "input", lambda: cut_lineage(Plant(spark, sf_dir).regression_input, "regression_input")
    )


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage(spark, sf_dir, "rows", lambda: reg.prepare(reg.model_rows(_input(spark, sf_dir))))


def _pooled(spark: SparkSession, sf_dir: str) -> RegressionRun:
    return _stage(spark, sf_dir, "pooled", lambda: run_targets(_input(spark, sf_dir)))


def _each(spark: SparkSession, sf_dir: str) -> RegressionRun:
    return _stage(
        spark, sf_dir, "each", lambda: run_targets(_input(spark, sf_dir), by=["machine_id"], strict=False)
    )


EACH = ("target", "machine_id")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


def _with(run: Callable[[SparkSession, str], object], view: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(view(run(pin_utc(spark), sf_dir)))


def _documents(run: RegressionRun) -> DataFrame:
    return report.model_documents(run.metrics, run.coefficients, run.sensitivity, run.by)


def _dashboard(run: RegressionRun) -> DataFrame:
    return report.dashboard_rows(_documents(run), run.by)


def _effect_names(run: RegressionRun) -> DataFrame:
    split = report.effects_split(_documents(run), run.by)
    return split.withColumns(
        {
            c: F.transform(c, lambda r: r["feature"])
            for c in ("significant_effects", "non_significant_effects")
        }
    )


def _glm_parameters(rows: DataFrame) -> DataFrame:
    fit = reg.fit_gamma_glm(rows)
    scale = fit.usable.select("target", "scale")
    return reg.parameters(fit).join(scale, "target").drop("model_type", "p_value")


def _flagged(run: RegressionRun) -> DataFrame:
    return report.significant_coefficients(run.coefficients)


MODELS: dict[str, Query] = {
    "model_dataset": lambda spark, sf_dir: _rows(pin_utc(spark), sf_dir),
    "fit_log_ols": _with(_rows, lambda r: reg.parameters(reg.fit_log_ols(r)).drop("model_type", "p_value")),
    "fit_gamma_glm": _with(_rows, _glm_parameters),
    "run_targets": lambda spark, sf_dir: _run_targets(pin_utc(spark), sf_dir),
    "fit_from_moments": lambda spark, sf_dir: _fit_from_moments(pin_utc(spark), sf_dir),
    "model_status": _with(_each, lambda r: r.status),
    "coefficients": _with(_pooled, lambda r: r.coefficients),
    "coefficients_by_machine": _with(_each, lambda r: r.coefficients),
    "sensitivity": _with(_pooled, lambda r: r.sensitivity),
    "sensitivity_rank": _with(_each, lambda r: r.sensitivity),
    "model_metrics": _with(_pooled, lambda r: r.metrics),
    "stack_models": _with(_each, lambda r: r.metrics),
    "vif": _with(_rows, reg.vif),
    "breusch_pagan": _with(_pooled, lambda r: r.breusch_pagan),
    "correlation_matrix": _with(_rows, reg.correlation_matrix),
    "univariate_gamma_glm": _with(_rows, reg.univariate_gamma_glm),
    "univariate_order": _with(_rows, lambda r: reg.univariate_order(reg.univariate_gamma_glm(r))),
}

REPORT: dict[str, Query] = {
    "select_model_metrics": _with(
        _each, lambda r: report.select_model_metrics(r.metrics, k.PRIMARY_TARGET, k.GAMMA_GLM)
    ),
    "significant_coefficients": _with(_each, _flagged),
    "rank_significance": _with(_each, lambda r: report.rank_significance(_flagged(r), r.by)),
    "sensitivity_rows": _with(_each, lambda r: report.sensitivity_rows(r.sensitivity)),
    "univariate_rows": _with(_rows, lambda r: report.univariate_rows(reg.univariate_gamma_glm(r))),
    "vif_rows": _with(_rows, lambda r: report.vif_rows(reg.vif(r))),
    "top_sensitivity": _with(
        _each, lambda r: report.top_sensitivity(report.sensitivity_rows(r.sensitivity), r.by)
    ),
    "effects_split": _with(_each, _effect_names),
    "regression_summary": lambda spark, sf_dir: _flattened(_summary_frame(spark, sf_dir, _pooled)),
    "regression_summary_by_machine": lambda spark, sf_dir: _flattened(_summary_frame(spark, sf_dir, _each), EACH),
    "model_explanation": _with(_each, lambda r: _dashboard(r).select("machine_id", "model_scope", "explanation")),
    "sensitivity_message": _with(
        _each, lambda r: _dashboard(r).select("machine_id", "model_scope", "sensitivity_message")
    ),
    "technical_note": _with(_each, lambda r: _dashboard(r).select("machine_id", "model_scope", "technical_note")),
    "dashboard_rows": _with(_pooled, _dashboard),
    "dashboard_rows_by_machine": _with(_each, _dashboard),
    "panel_explanations": _with(_pooled, lambda r: panels.explanations(_dashboard(r))),
    "panel_sensitivities": _with(_pooled, lambda r: panels.sensitivities(_dashboard(r))),
    "dq_check_model_scope": _with(
        _each,
        # Scopes of every other machine are no published ones.
        lambda r: quality.check_model_scope(
            _dashboard(r).withColumn(
                "model_scope",
                F.when(
                    F.substring("machine_id", -1, 1).isin("1", "3", "5", "7", "9"),
                    F.concat_ws(":", "machine_id", "model_scope"),
                ).otherwise(F.col("model_scope")),
            )
        ),
    ),
}


def _summary_frame(spark: SparkSession, sf_dir: str, fits: Callable[[SparkSession, str], RegressionRun]) -> DataFrame:
    run = fits(pin_utc(spark), sf_dir)
    return report.regression_summary(_documents(run), run.univariate, run.vif, run.by)


def _flattened(documents: DataFrame, keys: tuple[str, ...] = ("target",)) -> DataFrame:
    """Every cell of the nested documents as a row (keys, section, position, name, value, text)."""
    sections = {
        "metrics": F.array("metrics"),
        **{c: F.col(c) for c in ("significant_coefficients", "sensitivity", "univariate_gamma_glm", "vif")},
    }
    frames = []
    for section, rows in sections.items():
        one = documents.select(*keys, F.posexplode(rows).alias("position", "_r"))
        cells = []
        for f in one.schema["_r"].dataType.fields:
            if f.name in keys:
                continue
            number = isinstance(f.dataType, T.NumericType)
            cell = F.col("_r")[f.name]
            cells.append(
                F.struct(
                    F.lit(f.name).alias("name"),
                    (cell.cast("double") if number else F.lit(None).cast("double")).alias("value"),
                    (F.lit(None).cast("string") if number else cell.cast("string")).alias("text"),
                )
            )
        flat = one.select(*keys, F.col("position").cast("bigint").alias("position"), F.explode(F.array(*cells)).alias("_c"))
        frames.append(flat.select(*keys, F.lit(section).alias("section"), "position", "_c.*"))
    return rounded(reg.stack_models(frames))


# --- files -----------------------------------------------------------------------


def _union_by_name(frames: dict[str, DataFrame]) -> DataFrame:
    """The rows of several tables below each other, with the table's name."""
    named = [df.withColumn("table_name", F.lit(name)) for name, df in frames.items()]
    out = named[0]
    for frame in named[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def _scan_seed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole seed load: all six tables written as CSV by Spark and read back."""
    directory = scratch_path(spark, "seeds")
    for name, df in Plant(spark, sf_dir).tables.items():
        sinks.export_csv(df, f"{directory}/{name}.csv")
    tables = seed_csv.read_seed_tables(spark, directory)
    return _union_by_name({name: plain(df) for name, df in tables.items()})


def _project_seed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with foreign columns in another order, reduced to the declared ones."""
    directory = scratch_path(spark, "seeds")
    samples = Plant(spark, sf_dir).samples
    names = list(reversed(samples.columns))
    wide = samples.select(F.lit("x").alias("comment"), *names, F.lit(1).alias("row_version"))
    sinks.export_csv(wide, f"{directory}/energy_measurement.csv")
    return plain(seed_csv.read_seed_table(spark, directory, "energy_measurement"))


def _parse_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned stops in every accepted spelling."""
    rows = derived.load(pin_utc(spark), sf_dir, "events").select("event_id", "event_type")
    words = F.array(*[F.lit(w) for w in ["true", " True ", "1", "yes", "Y", "false", "FALSE", "0", "no", " n"]])
    text = F.when(F.col("event_type") != "error", F.get(words, F.col("event_id") % 10))
    return rows.select("event_id", seed_csv.parse_bool(text).alias("parsed"))


def _normalize_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text values of which some mean missing."""
    rows = derived.load(pin_utc(spark), sf_dir, "events")
    text = (
        F.when(F.col("event_type") == "view", "NaN")
        .when(F.col("event_type") == "click", "")
        .when(F.col("event_type") == "error", "n/a")
        .otherwise(F.col("value").cast("string"))
    )
    raw = rows.select(F.col("event_id").cast("string").alias("event_id"), text.alias("value"))
    declared = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DecimalType(10, 3))])
    return plain(seed_csv.normalize_nulls(raw, declared))


def _scan_regression_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "regression_base_hourly")
    sinks.write_by_date(Plant(spark, sf_dir).base, path, "bucket_start")
    return readers.scan_regression_base(spark, path)


def _exported_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "regression_input.csv")
    sinks.export_csv(_input(pin_utc(spark), sf_dir), path)
    return readers.scan_regression_csv(spark, path)


def _exported_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 22 columns, written as CSV and read back by their types."""
    path = scratch_path(spark, "regression_base_hourly.csv")
    sinks.export_csv(Plant(spark, sf_dir).base, path)
    return readers.scan_typed_csv(spark, path, schemas.REGRESSION_BASE)


def _scanned_summary(fits: Callable[[SparkSession, str], RegressionRun], keys: tuple[str, ...]) -> Query:
    """The nested documents written as JSON and read back, flattened to their figures."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = _summary_frame(spark, sf_dir, fits)
        path = scratch_path(spark, "summary.json")
        documents.write.json(path)
        return _flattened(readers.scan_summary_json(spark, path, documents.schema), keys)

    return run


def _stored_rows(spark: SparkSession, directory: str, tables: Sequence[str]) -> DataFrame:
    return _union_by_name({t: plain(store.read_table(spark, directory, t)) for t in tables})


def _full_refresh_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables after a refresh over published figures: base tables are new, the rest is empty."""
    out_dir = scratch_path(spark, "plant")
    plant = Plant(spark, sf_dir)
    _publish_all(spark, plant, out_dir)
    sinks.full_refresh(spark, plant.tables, out_dir, quality.primary_keys)
    return _stored_rows(spark, out_dir, [*schemas.BASE_TABLES, *schemas.DERIVED_TABLES, *schemas.HOURLY_TABLES])


def _rebuild_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both derived tables, read back."""
    out_dir = scratch_path(spark, "plant")
    sinks.rebuild_enriched(spark, Plant(spark, sf_dir).tables, out_dir)
    return _stored_rows(spark, out_dir, list(schemas.DERIVED_TABLES))


def _publish_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four hourly tables, read back whole."""
    return _stored_rows(spark, _published(spark, sf_dir), list(schemas.HOURLY_TABLES))


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both derived tables, counted while they were rebuilt."""
    out_dir = scratch_path(spark, "plant")
    sinks.rebuild_enriched(spark, Plant(spark, sf_dir).tables, out_dir)
    return sinks.published_counts(spark, out_dir, list(schemas.DERIVED_TABLES))


#: Rows that come late to a published plant: a few hours of two days, and all of the last days.
LATE = "to_date({ts}) IN (DATE'2024-01-10', DATE'2024-01-17') AND hour({ts}) % 6 = 1 OR {ts} >= TIMESTAMP_NTZ'2024-01-30'"


def _came_late(table: str) -> Column:
    return F.expr(LATE.format(ts="cycle_start_ts" if table == "cycle_event" else "ts"))


def _published_early(spark: SparkSession, plant: Plant, arrived: Callable[[str], Column]) -> str:
    """A published plant of the rows that had arrived, ready for incremental refreshes."""
    out_dir = scratch_path(spark, "plant")
    early = {t: df.filter(arrived(t)) if t in incremental.SERIES else df for t, df in plant.tables.items()}
    sinks.full_refresh(spark, early, out_dir, quality.primary_keys)
    stored = {t: store.read_table(spark, out_dir, t) for t in schemas.BASE_TABLES}
    sinks.rebuild_enriched(spark, stored, out_dir)
    sinks.publish_hourly(spark, {**stored, "energy_enriched": store.read_table(spark, out_dir, "energy_enriched")}, out_dir)
    incremental.publish_days(spark, out_dir)
    return out_dir


def _refresh_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived and hourly tables after late rows were added to a published plant: all rows are in."""
    plant = Plant(spark, sf_dir)
    out_dir = _published_early(spark, plant, lambda table: ~_came_late(table))
    late = {table: plant.tables[table].filter(_came_late(table)) for table in incremental.SERIES}
    incremental.refresh(spark, out_dir, late, quality.primary_keys)
    return _stored_rows(spark, out_dir, [*schemas.DERIVED_TABLES, *schemas.HOURLY_TABLES])


def _through_json(spark: SparkSession, frame: DataFrame) -> DataFrame:
    path = scratch_path(spark, "metadata.json")
    sinks.export_run_metadata(frame, path)
    return spark.read.schema(frame.schema).json(path)


def _export_run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both frames of the regression input exported, and the metadata read back from its file."""
    out_dir = scratch_path(spark, "regression")
    base = cut_lineage(Plant(spark, sf_dir).base, "regression_base_hourly")
    return sinks.export_regression_input(base, kpi.aggregate_regression_input(base), out_dir)


def _run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = _through_json(spark, sinks.run_metadata(_rows(pin_utc(spark), sf_dir)))
    return written.withColumn("features", F.array_join("features", ","))


def _result_cells(tables: dict[str, DataFrame]) -> DataFrame:
    """Every cell of the result tables of a run: (table, keys, column, value)."""
    frames = []
    for name, df in tables.items():
        keys = [c for c, t in df.dtypes if t in ("string", "timestamp_ntz")]
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
        figures = [c for c in df.columns if c not in keys]
        cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in figures])
        rows = df.select(F.lit(name).alias("table_name"), key.alias("key"), F.explode(cells).alias("_c"))
        # Results of an iteration agree to fewer digits than the rows it read.
        frames.append(rounded(rows.select("table_name", "key", "_c.*"), 9 if name == "model_dataset" else 6))
    return reg.stack_models(frames)


def _run_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All result tables of both targets, from a run of its own."""
    return _result_cells(run_targets(_input(spark, sf_dir)).tables())


def _export_model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of every exported table, read back from the files."""
    out_dir = scratch_path(spark, "models")
    tables = _pooled(pin_utc(spark), sf_dir).tables()
    back = {}
    for name in sinks.export_model_outputs(_pooled(spark, sf_dir), out_dir):
        back[name] = readers.scan_typed_csv(spark, f"{out_dir}/{name}", tables[name].schema)
    return _result_cells(back)


def _fit_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of the pooled log-OLS from the published moments of all days: (target, section, name, value)."""
    out_dir = _published(spark, sf_dir)
    if sinks.MOMENTS not in store.current(spark, out_dir):
        sinks.publish_moments(spark, out_dir)
    fit = moments.fit_log_ols(store.read_table(spark, out_dir, sinks.MOMENTS))

    def cells(section: str, df: DataFrame, named: str | None, columns: Sequence[str]) -> DataFrame:
        prefix = F.concat(F.col(named), F.lit(".")) if named else F.lit("")
        values = [F.struct(F.concat(prefix, F.lit(c)).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]
        return df.select("target", F.lit(section).alias("section"), F.inline(F.array(*values)))

    return rounded(
        reg.stack_models(
            [
                cells("coefficients", fit.coefficients, "parameter", ["coefficient"]),
                cells("metrics", fit.metrics, None, ["n_obs", "aic", "bic", "rsquared", "rsquared_adj"]),
                cells("vif", fit.vif, "feature", ["vif"]),
                cells("correlation", fit.correlation, "variable", [*k.FEATURES, reg.Y]),
            ]
        )
    )


def _upsert_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows of an older run, then the merge that replaces one and adds the other."""
    path = scratch_path(spark, "regression_dashboard_summary")
    rows = _dashboard(_pooled(pin_utc(spark), sf_dir))
    sinks.create_dashboard(spark, path)
    older = rows.filter(F.col("model_scope") == "primary").withColumn("headline", F.lit("old"))
    sinks.upsert_dashboard(spark, path, older)
    return rounded(sinks.upsert_dashboard(spark, path, rows).drop("updated_at"))


FILES: dict[str, Query] = {
    "scan_seed_csv": _scan_seed_csv,
    "project_seed_columns": _project_seed_columns,
    "parse_bool": _parse_bool,
    "normalize_nulls": _normalize_nulls,
    "scan_regression_base": _scan_regression_base,
    "scan_regression_csv": _exported_input,
    "scan_summary_json": _scanned_summary(_pooled, ("target",)),
    "scan_summary_json_by_machine": _scanned_summary(_each, EACH),
    "full_refresh_load": _full_refresh_load,
    "rebuild_enriched": _rebuild_enriched,
    "publish_hourly": _publish_hourly,
    "publish_hourly_whole": _publish_hourly,
    "refresh_published": _refresh_published,
    "export_csv": _exported_base,
    "export_run_metadata": _export_run_metadata,
    "run_metadata": _run_metadata,
    "export_model_outputs": _export_model_outputs,
    "upsert_dashboard": _upsert_dashboard,
}


# --- streams ---------------------------------------------------------------------


#: The stream's watermark, and how its input arrives: a folder per five days, and of the first folder every
#: seventh second only with the last one, weeks later than the watermark allows.
STREAM_DELAY = "2 days"
STREAM_ARRIVALS = 7


def _arriving(spark: SparkSession, enriched: DataFrame, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """One arrival after another, each a folder of as many files as the rows have tasks; after each the
    stream runs until it has read what is there, as one micro-batch.

    The rows are dealt to all arrivals in one pass; an arrival's folder then moves to where the stream looks.
    """
    path, dealt = scratch_path(spark, "arrivals"), scratch_path(spark, "dealt")
    day = F.dayofmonth("ts") + F.when(F.month("ts") > 1, 31).otherwise(0)
    late = (day <= 5) & (F.unix_seconds(F.col("ts").cast("timestamp")) % 7 == 0)
    last = F.lit(STREAM_ARRIVALS - 1)
    arrival = F.when(late, last).otherwise(F.least(F.floor((day - 1) / 5), last))
    enriched.withColumn("arrival", arrival).write.partitionBy("arrival").parquet(dealt)
    for number in range(STREAM_ARRIVALS):
        if not store.move(spark, f"{dealt}/arrival={number}", f"{path}/{number}"):
            spark.createDataFrame([], enriched.schema).write.parquet(f"{path}/{number}")
        start(hourly.enriched_stream(spark, f"{path}/*")).awaitTermination()


def _streamed(build, keys: list[str]) -> Query:
    """Several micro-batches with late rows; the log of updates is compacted and its newest rows are taken."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        log, checkpoint = scratch_path(spark, "updates"), scratch_path(spark, "stream_checkpoint")
        _arriving(
            spark,
            Plant(spark, sf_dir).enriched,
            lambda stream: hourly.start_updates(build(stream, STREAM_DELAY), log, checkpoint),
        )
        hourly.compact(spark, log, keys)
        return plain(hourly.latest(spark, log, keys))

    return run


def _closed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append form: hours that the watermark has closed, each written once."""
    closed, checkpoint = scratch_path(spark, "closed"), scratch_path(spark, "stream_checkpoint")
    _arriving(
        spark,
        Plant(spark, sf_dir).enriched,
        lambda stream: hourly.start_append(hourly.state_energy_hourly(stream, STREAM_DELAY), closed, checkpoint),
    )
    return plain(spark.read.parquet(closed))


def _stream_into_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived and hourly tables of a plant that began empty and was fed by a stream, late rows last."""
    plant = Plant(spark, sf_dir)
    out_dir, checkpoint = _published_early(spark, plant, lambda _: F.lit(False)), scratch_path(spark, "stream_checkpoint")
    arrivals = scratch_path(spark, "arrivals")
    for number in range(2):
        for table in incremental.SERIES:
            rows = plant.tables[table].filter(_came_late(table) if number else ~_came_late(table))
            rows.write.parquet(f"{arrivals}/{table}/{number}")
        stream = published.series_stream(spark, {table: f"{arrivals}/{table}/*" for table in incremental.SERIES})
        published.start_published(stream, out_dir, "plant", checkpoint, quality.primary_keys).awaitTermination()
    return _stored_rows(spark, out_dir, [*schemas.DERIVED_TABLES, *schemas.HOURLY_TABLES])


def _stream_energy_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples enriched as they arrive, a folder per eight days, every other second's rows a day late; those
    that the watermark of three days has passed in the end."""
    plant = Plant(spark, sf_dir)
    arrivals, out = scratch_path(spark, "arrivals"), scratch_path(spark, "enriched")
    checkpoint = scratch_path(spark, "stream_checkpoint")
    for number in range(5):
        for table in incremental.SERIES:
            at = F.col("cycle_start_ts" if table == "cycle_event" else "ts")
            late = F.unix_seconds(at.cast("timestamp")) % 2
            days = F.datediff(at, F.lit(derived.WINDOW[0][:10]).cast("date"))
            arrival = F.least(F.floor((days + late) / 8), F.lit(4))
            plant.tables[table].filter(arrival == number).write.parquet(f"{arrivals}/{table}/{number}")
        stream = published.series_stream(spark, {table: f"{arrivals}/{table}/*" for table in incremental.SERIES})
        hourly.start_append(streamed.energy_enriched(stream, "3 days"), out, checkpoint).awaitTermination()
    return plain(spark.read.schema(schemas.ENERGY_ENRICHED).parquet(out))


STREAMS: dict[str, Query] = {
    "stream_state_energy_hourly": _streamed(hourly.state_energy_hourly, hourly.HOURLY_KEYS),
    "stream_detailed_state_hourly": _streamed(hourly.detailed_state_hourly, hourly.DETAILED_KEYS),
    "stream_closed_hours": _closed_hours,
    "stream_into_published": _stream_into_published,
    "stream_energy_enriched": _stream_energy_enriched,
}


def queries() -> dict[str, Query]:
    return {**ALIGNMENT, **HOURLY, **PANELS, **QUALITY, **MODELS, **REPORT, **FILES, **STREAMS}
