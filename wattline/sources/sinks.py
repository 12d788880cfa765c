"""Writers: full refresh, rebuilt derived tables, exports and the keyed upsert."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions import constants as k
from wattline.operators import moments
from wattline.operators.regression import model_rows
from wattline.plans import enrich, kpi
from wattline.plans.regression import RegressionRun
from wattline.session import cut_lineage
from wattline.sources.store import (
    RefreshRejected,
    counted_write,
    publication,
    publish,
    read_table,
    snapshot,
    write_by_date,
)

__all__ = [
    "RefreshRejected",
    "create_dashboard",
    "export_csv",
    "export_model_outputs",
    "export_regression_input",
    "export_run_metadata",
    "full_refresh",
    "input_metadata",
    "publish_hourly",
    "publish_moments",
    "published_counts",
    "rebuild_enriched",
    "run_metadata",
    "upsert",
    "upsert_dashboard",
    "write_by_date",
]

DASHBOARD, MOMENTS = "regression_dashboard_summary", "regression_moments"


def full_refresh(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    out_dir: str,
    violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
) -> None:
    """Load the base tables anew; what is derived from the old ones is cleared in the same publication."""
    base = {t: frames[t].select(*schema.names) for t, schema in schemas.BASE_TABLES.items()}
    outdated = [*schemas.DERIVED_TABLES, *schemas.HOURLY_TABLES, *schemas.DAY_TABLES, MOMENTS]
    publish(spark, base, out_dir, violations, clear=outdated)


def rebuild_enriched(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str) -> None:
    """Compute `energy_enriched` and `cycle_energy_summary` and publish both at once; older hourly tables are cleared.

    The summary is computed from the staged enriched rows, so the alignment runs and is written a
    single time, and no reader sees one table without the other.
    """
    inputs = tables["energy_measurement"], tables["machine_state_event"], tables["cycle_event"]
    with publication(spark, out_dir, clear=[*schemas.HOURLY_TABLES, *schemas.DAY_TABLES, MOMENTS]) as staged:
        enriched = staged.write("energy_enriched", enrich.energy_enriched(*inputs))
        staged.write("cycle_energy_summary", enrich.cycle_energy_summary(tables["cycle_event"], enriched))


def publish_hourly(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str) -> None:
    """Compute and replace the four hourly tables that dashboards and the regression read.

    `tables` are the base tables and `energy_enriched`. The samples are read once, into the cube, and
    the hourly figures are joined once, into the spine, which two of the tables are computed from;
    readers then prune by day (`store.read_published_range`).
    """
    cube = cut_lineage(kpi.energy_cube(tables["energy_enriched"]), "energy_cube")
    states, cycles, samples = (
        tables[t] for t in ("machine_state_event", "cycle_event", "energy_measurement")
    )
    bounds = kpi.machine_time_bounds(tables["machine"], samples, states, cycles)
    bucketed = kpi.state_interval_bucketed(kpi.state_intervals(states, bounds))
    stats = kpi.cycle_stats_of(enrich.cycles_with_energy(cycles, cube), tables["operation"])
    with publication(spark, out_dir) as staged:
        energy = staged.write("state_energy_summary_hourly", kpi.state_energy_summary_hourly(cube))
        staged.write("detailed_state_energy_summary_hourly", kpi.detailed_from_cube(cube))
        spine = cut_lineage(kpi.spine_left_joins(energy, kpi.state_time_hourly(bucketed), stats), "spine")
        staged.write("oee_energy_summary_hourly", kpi.oee_of_spine(spine))
        staged.write("regression_base_hourly", kpi.regression_base_of_spine(spine))


def moments_of(base: DataFrame) -> DataFrame:
    """The rows of `regression_moments` from rows of `regression_base_hourly` (whole days)."""
    return moments.daily_moments(model_rows(kpi.aggregate_regression_input(base)))


def publish_moments(spark: SparkSession, out_dir: str) -> None:
    """Publish the sums that regressions of any range can be fitted from; refreshes keep them up to date."""
    with publication(spark, out_dir) as staged:
        staged.write(MOMENTS, moments_of(staged.read("regression_base_hourly")))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV part files with headers; times are written with the UTC offset."""
    columns = [
        F.date_format(F.col(name).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSSXXX").alias(name)
        if kind.startswith("timestamp")
        else F.col(name)
        for name, kind in df.dtypes
    ]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def export_regression_input(base: DataFrame, regression_input: DataFrame, out_dir: str) -> DataFrame:
    """The hourly base and the regression input as CSV, and their metadata as JSON; returns the metadata.

    Row counts come from the writes themselves.
    """
    spark = base.sparkSession
    rows = {
        name: counted_write(df, lambda counted, name=name: export_csv(counted, f"{out_dir}/{name}.csv"))
        for name, df in (("regression_base_hourly", base), ("regression_input", regression_input))
    }
    metadata = input_metadata(spark, rows["regression_base_hourly"], rows["regression_input"])
    export_run_metadata(metadata, f"{out_dir}/regression_metadata.json")
    return spark.read.schema(metadata.schema).json(f"{out_dir}/regression_metadata.json")


def input_metadata(spark: SparkSession, raw_rows: int, rows_used: int) -> DataFrame:
    """Parameters and row counts of the regression input; one row."""
    return spark.range(1).select(
        F.lit(k.AGGREGATION_HOURS).alias("aggregation_hours"),
        F.lit(k.MIN_GOOD_PARTS).alias("min_good_parts_for_regression"),
        F.lit(k.PRIMARY_TARGET).alias("primary_target"),
        F.lit(k.SECONDARY_TARGET).alias("secondary_target"),
        F.lit(raw_rows).cast("bigint").alias("raw_rows"),
        F.lit(rows_used).cast("bigint").alias("aggregated_rows_after_filtering"),
    )


def published_counts(spark: SparkSession, directory: str, tables: Sequence[str]) -> DataFrame:
    """Rows of published tables as their publication counted them; no table is read."""
    held = snapshot(spark, directory)
    return spark.createDataFrame([(table, held.rows(table)) for table in tables], "table_name string, row_count bigint")


def run_metadata(rows: DataFrame, features: Sequence[str] = k.FEATURES) -> DataFrame:
    """Features, targets and the rows each target used; one row."""
    return rows.agg(
        F.count_if(F.col("target") == k.PRIMARY_TARGET).alias("primary_rows_used"),
        F.count_if(F.col("target") == k.SECONDARY_TARGET).alias("secondary_rows_used"),
    ).select(
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.lit(k.PRIMARY_TARGET).alias("primary_target"),
        F.lit(k.SECONDARY_TARGET).alias("secondary_target"),
        "primary_rows_used",
        "secondary_rows_used",
    )


def export_run_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").json(path)


def export_model_outputs(run: RegressionRun, out_dir: str) -> list[str]:
    """Every result table of a run, all targets stacked, as CSV; returns the table names."""
    tables = run.tables()
    for name, df in tables.items():
        export_csv(df, f"{out_dir}/{name}")
    return list(tables)


def upsert(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """`target` with the rows of `new` inserted or, where the key exists, put in their place."""
    kept = target.join(new.select(*key), list(key), "left_anti")
    return kept.unionByName(new.select(*target.columns))


def upsert_dashboard(spark: SparkSession, out_dir: str, rows: DataFrame) -> DataFrame:
    """Merge stamped report rows into the published dashboard table, in one commit; returns the table.

    Files that hold none of the scopes are kept, and readers see the old table or the new one.
    """
    stamped = rows.withColumn("updated_at", F.current_timestamp())
    with publication(spark, out_dir) as staged:
        staged.merge(DASHBOARD, stamped, ["model_scope"])
    return read_table(spark, out_dir, DASHBOARD)


def create_dashboard(spark: SparkSession, out_dir: str) -> None:
    """An empty dashboard table, if none is published yet."""
    if DASHBOARD not in snapshot(spark, out_dir).tables:
        publish(spark, {DASHBOARD: spark.createDataFrame([], schemas.DASHBOARD_SUMMARY)}, out_dir)
