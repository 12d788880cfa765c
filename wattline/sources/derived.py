"""Machine tables derived from the star-schema test tables.

The test data has no machine series, so every row of `events` is read as a
power sample, as a state change and as the start of a production cycle of one
machine; `supplier` gives the machines and `part` the operations. All rows of
the source tables are used. Remainders below only make up values (delays,
missing readings, results); they never select rows.

`input_tables` gives consistent tables. `raw_feed` gives the same rows before
cleaning: they break the data-quality rules in places.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions import constants as k
from wattline.functions.timeline import seconds_later
from wattline.operators.temporal import to_intervals
from wattline.session import cut_lineage, pin_utc, shared_dir

WINDOW = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "event_type",
        "value",
        F.concat(F.lit("M"), F.expr("user_id div 10")).alias("machine_id"),
        F.expr("user_id div 10").alias("machine_no"),
    )


def machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One machine per supplier, numbered from 1: machine M0 has events but no master row."""
    return load(spark, sf_dir, "supplier").select(
        F.concat(F.lit("M"), F.col("s_suppkey") + 1).alias("machine_id"),
        F.col("s_name").alias("machine_name"),
        F.concat(F.lit("Maker "), F.col("s_nationkey")).alias("manufacturer"),
        F.lit(None).cast("string").alias("model"),
        F.lit("machining center").alias("machine_type"),
    )


def operation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.concat(F.lit("OP_"), F.col("p_partkey")).alias("operation_id"),
        F.col("p_name").alias("operation_name"),
        (F.lit(1500) + F.col("p_size") * 100).cast("decimal(10,2)").alias("ideal_cycle_time_sec"),
    )


def state_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        k.STATE_MAPPING_ROWS,
        "detailed_state_code string, detailed_state_name string, state_tag string, oee_loss_type string",
    )


def energy_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A meter that grows by 0.013 per second and wraps at 700; some readings are missing."""
    ev = _event_rows(spark, sf_dir)
    thousandths = (F.unix_seconds(F.col("ts").cast("timestamp")) * 13 + F.col("machine_no") * 1009) % 700_000
    counter = (thousandths.cast("decimal(9,0)") * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(12,5)")
    return ev.select(
        "ts",
        "machine_id",
        F.col("value").cast("decimal(10,3)").alias("power_kw"),
        F.when(F.col("event_id") % 17 != 0, counter).alias("energy_kwh_cumulative"),
        F.when(F.col("event_id") % 13 != 0, F.lit(60)).cast("decimal(10,3)").alias("sample_interval_sec"),
    )


def machine_state_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event reports a state, up to half an hour late."""
    ev = _event_rows(spark, sf_dir)
    code = (
        F.when(F.col("event_type").isin("click", "purchase"), "RUN")
        .when(F.col("event_type") == "view", k.STATE_IDLE)
        .when(F.col("event_type") == "signup", "MICRO_STOP")
        .otherwise(k.STATE_FAILURE)
    )
    tag = F.lit(None).cast("string")
    for state, _, state_tag, _ in k.STATE_MAPPING_ROWS:
        tag = F.when(F.col("detailed_state_code") == state, state_tag).otherwise(tag)
    idle = F.col("detailed_state_code") == k.STATE_IDLE
    return ev.withColumn("detailed_state_code", code).select(
        seconds_later(F.col("ts"), F.col("event_id") * 37 % 1800).alias("ts"),
        "machine_id",
        "detailed_state_code",
        tag.alias("state_tag"),
        F.lit(None).cast("string").alias("reason_code"),
        F.when(F.col("event_id") % 11 != 0, idle & (F.col("event_id") % 7 == 0)).alias("is_planned_stop"),
        F.when(idle & (F.col("event_id") % 3 != 0), k.REASON_WAITING).alias("idle_reason"),
    )


def _cycle_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _event_rows(spark, sf_dir)
    return ev.select(
        F.concat(F.lit("C"), F.col("event_id")).alias("cycle_id"),
        "machine_id",
        F.concat(F.lit("OP_"), F.expr("event_id div 5") + 1).alias("operation_id"),
        seconds_later(F.col("ts"), F.col("event_id") * 53 % 3600).alias("cycle_start_ts"),
        (F.lit(1800) + F.col("event_id") % 200 * 37).cast("decimal(10,3)").alias("actual_cycle_time_sec"),
        F.when(F.col("event_id") % 3 == 0, k.RESULT_SCRAP).otherwise(k.RESULT_GOOD).alias("part_result"),
        F.when(F.col("event_id") % 3 == 0, "tolerance").alias("scrap_reason"),
    )


_CYCLE_COLUMNS = (
    "cycle_id",
    "machine_id",
    "operation_id",
    "cycle_start_ts",
    "cycle_end_ts",
    "actual_cycle_time_sec",
    "part_result",
    "scrap_reason",
)


def cycle_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cycle ends after its own time, or when the next one of the machine starts."""
    starts = to_intervals(_cycle_starts(spark, sf_dir), ["machine_id"], "cycle_start_ts", "_next")
    own_end = seconds_later(F.col("cycle_start_ts"), F.col("actual_cycle_time_sec"))
    return starts.withColumn("cycle_end_ts", F.least(own_end, F.col("_next"))).select(*_CYCLE_COLUMNS)


def input_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "machine": machine(spark, sf_dir),
        "operation": operation(spark, sf_dir),
        "state_mapping": state_mapping(spark),
        "machine_state_event": machine_state_event(spark, sf_dir),
        "cycle_event": cycle_event(spark, sf_dir),
        "energy_measurement": energy_measurement(spark, sf_dir),
    }


def raw_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same tables with defects: values too wide, bad signs, gaps, repeats, overlaps."""
    number = F.regexp_extract("cycle_id", "C([0-9]+)", 1).cast("long")
    own_end = seconds_later(F.col("cycle_start_ts"), F.col("actual_cycle_time_sec"))
    cycles = _cycle_starts(spark, sf_dir).select(
        F.when(number % 101 == 0, "C101").otherwise(F.col("cycle_id")).alias("cycle_id"),
        F.when(number % 89 != 0, F.col("machine_id")).alias("machine_id"),
        "operation_id",
        "cycle_start_ts",
        F.when(number % 53 == 0, F.col("cycle_start_ts")).otherwise(own_end).alias("cycle_end_ts"),
        ((F.col("actual_cycle_time_sec") - 1837) * 2000).cast("decimal(14,3)").alias("actual_cycle_time_sec"),
        F.when(number % 37 == 0, "rework").otherwise(F.col("part_result")).alias("part_result"),
        "scrap_reason",
    )
    samples = energy_measurement(spark, sf_dir).withColumns(
        {
            "power_kw": (F.col("power_kw") - 5).cast("decimal(10,3)"),
            "sample_interval_sec": F.when(F.col("power_kw") < 1, F.lit(0).cast("decimal(10,3)")).otherwise(
                F.col("sample_interval_sec")
            ),
        }
    )
    run_unplanned = (F.col("detailed_state_code") == "RUN") & F.col("is_planned_stop").isNull()
    states = machine_state_event(spark, sf_dir).withColumns(
        {
            "detailed_state_code": F.when(run_unplanned, "WARMUP").otherwise(F.col("detailed_state_code")),
            "state_tag": F.when(~run_unplanned, F.col("state_tag")),
        }
    )
    operations = operation(spark, sf_dir).withColumn(
        "ideal_cycle_time_sec", ((F.col("ideal_cycle_time_sec") - 1700) * 100000).cast("decimal(14,2)")
    )
    return {
        "machine": machine(spark, sf_dir),
        "operation": operations,
        "state_mapping": state_mapping(spark),
        "machine_state_event": states,
        "cycle_event": cycles,
        "energy_measurement": samples,
    }


def input_state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input files: what is stored of an input holds as long as this stays the same."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    files = []
    while found.hasNext():
        status = found.next()
        files.append(f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}")
    return "\n".join(sorted(files))


_STORED: dict[tuple[str, ...], dict[str, DataFrame]] = {}


def _stored(spark: SparkSession, sf_dir: str, kind: str, build) -> dict[str, DataFrame]:
    key = (spark.sparkContext.applicationId, sf_dir, input_state(spark, sf_dir), kind)
    if key not in _STORED:
        tables = build(pin_utc(spark), sf_dir)
        shared_dir(spark)
        # Independent jobs: Spark fills the cores that one small table leaves free.
        with ThreadPoolExecutor(len(tables)) as pool:
            written = pool.map(cut_lineage, tables.values(), tables.keys())
            _STORED[key] = dict(zip(tables, written))
    return _STORED[key]


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """`input_tables` written once per application and read from there, as a loaded database would be."""
    return _stored(spark, sf_dir, "clean", input_tables)


def stored_raw_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _stored(spark, sf_dir, "raw", raw_feed)
