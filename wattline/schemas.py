"""Table schemas: names, types and which columns must be filled."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


def _part(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([T.StructField(name, schema[name].dataType) for name in names])


TEXT = T.StringType()
TS = T.TimestampNTZType()
DOUBLE = T.DoubleType()
LONG = T.LongType()

REQUIRED, OPTIONAL = False, True

MACHINE = _schema(
    ("machine_id", TEXT, REQUIRED),
    ("machine_name", TEXT, REQUIRED),
    ("manufacturer", TEXT, OPTIONAL),
    ("model", TEXT, OPTIONAL),
    ("machine_type", TEXT, OPTIONAL),
)
OPERATION = _schema(
    ("operation_id", TEXT, REQUIRED),
    ("operation_name", TEXT, REQUIRED),
    ("ideal_cycle_time_sec", T.DecimalType(10, 2), REQUIRED),
)
STATE_MAPPING = _schema(
    ("detailed_state_code", TEXT, REQUIRED),
    ("detailed_state_name", TEXT, REQUIRED),
    ("state_tag", TEXT, REQUIRED),
    ("oee_loss_type", TEXT, OPTIONAL),
)
ENERGY_MEASUREMENT = _schema(
    ("ts", TS, REQUIRED),
    ("machine_id", TEXT, REQUIRED),
    ("power_kw", T.DecimalType(10, 3), REQUIRED),
    ("energy_kwh_cumulative", T.DecimalType(12, 5), OPTIONAL),
    ("sample_interval_sec", T.DecimalType(10, 3), OPTIONAL),
)
MACHINE_STATE_EVENT = _schema(
    ("ts", TS, REQUIRED),
    ("machine_id", TEXT, REQUIRED),
    ("detailed_state_code", TEXT, REQUIRED),
    ("state_tag", TEXT, REQUIRED),
    ("reason_code", TEXT, OPTIONAL),
    ("is_planned_stop", T.BooleanType(), OPTIONAL),
    ("idle_reason", TEXT, OPTIONAL),
)
CYCLE_EVENT = _schema(
    ("cycle_id", TEXT, REQUIRED),
    ("machine_id", TEXT, REQUIRED),
    ("operation_id", TEXT, REQUIRED),
    ("cycle_start_ts", TS, REQUIRED),
    ("cycle_end_ts", TS, REQUIRED),
    ("actual_cycle_time_sec", T.DecimalType(10, 3), REQUIRED),
    ("part_result", TEXT, REQUIRED),
    ("scrap_reason", TEXT, OPTIONAL),
)
ENERGY_ENRICHED = _schema(
    ("ts", TS, REQUIRED),
    ("machine_id", TEXT, REQUIRED),
    ("power_kw", T.DecimalType(10, 3), REQUIRED),
    ("delta_energy_kwh", T.DecimalType(12, 6), OPTIONAL),
    ("detailed_state_code", TEXT, OPTIONAL),
    ("state_tag", TEXT, OPTIONAL),
    ("cycle_id", TEXT, OPTIONAL),
)
CYCLE_ENERGY_SUMMARY = _schema(
    ("cycle_id", TEXT, REQUIRED),
    ("machine_id", TEXT, REQUIRED),
    ("operation_id", TEXT, REQUIRED),
    ("cycle_start_ts", TS, REQUIRED),
    ("cycle_end_ts", TS, REQUIRED),
    ("cycle_energy_kwh", T.DecimalType(12, 6), REQUIRED),
    ("part_result", TEXT, REQUIRED),
)
DASHBOARD_SUMMARY = _schema(
    ("model_scope", TEXT, REQUIRED),
    ("display_order", T.ShortType(), REQUIRED),
    ("updated_at", T.TimestampType(), REQUIRED),
    ("target_name", TEXT, REQUIRED),
    ("target_label", TEXT, REQUIRED),
    ("model_type", TEXT, REQUIRED),
    ("n_obs", T.IntegerType(), REQUIRED),
    ("pseudo_r2", DOUBLE, OPTIONAL),
    ("significant_features", TEXT, REQUIRED),
    ("non_significant_features", TEXT, OPTIONAL),
    ("headline", TEXT, REQUIRED),
    ("explanation", TEXT, REQUIRED),
    ("technical_note", TEXT, REQUIRED),
    ("sensitivity_message", TEXT, OPTIONAL),
)

#: What later days need to know of a machine's day; structs begin with their time.
MACHINE_DAY = _schema(
    ("machine_id", TEXT, OPTIONAL),
    ("day", T.DateType(), OPTIONAL),
    ("last_sample", _part(ENERGY_MEASUREMENT, "ts", "energy_kwh_cumulative"), OPTIONAL),
    (
        "last_state",
        _part(MACHINE_STATE_EVENT, "ts", "detailed_state_code", "state_tag", "is_planned_stop", "idle_reason"),
        OPTIONAL,
    ),
    ("max_end", TS, OPTIONAL),
    ("running", T.ArrayType(_part(CYCLE_EVENT, *[c for c in CYCLE_EVENT.names if c != "machine_id"])), OPTIONAL),
)
CYCLE_DAY_ENERGY = _schema(
    ("day", T.DateType(), OPTIONAL),
    ("cycle_id", TEXT, OPTIONAL),
    ("energy_kwh", T.DecimalType(22, 6), OPTIONAL),
)

BASE_TABLES: dict[str, T.StructType] = {
    "machine": MACHINE,
    "operation": OPERATION,
    "state_mapping": STATE_MAPPING,
    "machine_state_event": MACHINE_STATE_EVENT,
    "cycle_event": CYCLE_EVENT,
    "energy_measurement": ENERGY_MEASUREMENT,
}
DERIVED_TABLES: dict[str, T.StructType] = {
    "energy_enriched": ENERGY_ENRICHED,
    "cycle_energy_summary": CYCLE_ENERGY_SUMMARY,
}
ALL_TABLES = {**BASE_TABLES, **DERIVED_TABLES, "regression_dashboard_summary": DASHBOARD_SUMMARY}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "machine": ("machine_id",),
    "operation": ("operation_id",),
    "state_mapping": ("detailed_state_code",),
    "energy_measurement": ("ts", "machine_id"),
    "machine_state_event": ("ts", "machine_id"),
    "cycle_event": ("cycle_id",),
    "energy_enriched": ("ts", "machine_id"),
    "cycle_energy_summary": ("cycle_id",),
    "regression_dashboard_summary": ("model_scope",),
}

# (child table, foreign key column, parent table); the parent column has the same name.
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("energy_measurement", "machine_id", "machine"),
    ("machine_state_event", "machine_id", "machine"),
    ("machine_state_event", "detailed_state_code", "state_mapping"),
    ("cycle_event", "machine_id", "machine"),
    ("cycle_event", "operation_id", "operation"),
    ("energy_enriched", "machine_id", "machine"),
    ("energy_enriched", "detailed_state_code", "state_mapping"),
    ("energy_enriched", "cycle_id", "cycle_event"),
    ("cycle_energy_summary", "cycle_id", "cycle_event"),
    ("cycle_energy_summary", "machine_id", "machine"),
    ("cycle_energy_summary", "operation_id", "operation"),
]

REGRESSION_BASE_COLUMNS = [
    "bucket_start",
    "machine_id",
    "planned_time_sec",
    "availability_loss_sec",
    "ideal_cycle_time_total_sec",
    "actual_cycle_time_total_sec",
    "total_parts",
    "good_parts",
    "scrap_parts",
    "energy_total_kwh",
    "energy_productive_kwh",
    "energy_non_productive_kwh",
    "energy_non_productive_stop_kwh",
    "good_cycle_energy_kwh",
    "availability",
    "performance",
    "quality",
    "oee",
    "scrap_rate",
    "cycle_energy_per_good_part_kwh",
    "system_energy_per_good_part_kwh",
    "non_productive_energy_ratio",
]
REGRESSION_INPUT_COLUMNS = [
    "bucket_start",
    "machine_id",
    "availability",
    "performance",
    "quality",
    "oee",
    "good_parts",
    "total_parts",
    "scrap_parts",
    "scrap_rate",
    "energy_total_kwh",
    "energy_productive_kwh",
    "energy_non_productive_kwh",
    "energy_non_productive_stop_kwh",
    "good_cycle_energy_kwh",
    "cycle_energy_per_good_part_kwh",
    "system_energy_per_good_part_kwh",
    "non_productive_energy_ratio",
    "planned_time_sec",
    "availability_loss_sec",
    "ideal_cycle_time_total_sec",
    "actual_cycle_time_total_sec",
]
_COUNTS = {"total_parts", "good_parts", "scrap_parts"}


def _hourly(columns: list[str]) -> T.StructType:
    kinds = {"bucket_start": TS, "machine_id": TEXT, **{c: LONG for c in _COUNTS}}
    return T.StructType([T.StructField(c, kinds.get(c, DOUBLE)) for c in columns])


# Columns of the published hourly tables.
_STATE_SUMS = [
    "bucket_start",
    "machine_id",
    "energy_total_kwh",
    "energy_productive_kwh",
    "energy_non_productive_kwh",
    "energy_non_productive_stop_kwh",
    "productive_energy_ratio",
    "non_productive_energy_ratio",
]
_OEE = [
    "bucket_start",
    "machine_id",
    "availability",
    "performance",
    "quality",
    "oee",
    "energy_per_part_kwh",
    "energy_per_good_part_kwh",
    "cycle_energy_per_good_part_kwh",
    "system_energy_per_good_part_kwh",
    "energy_per_scrap_part_kwh",
    "energy_total_kwh",
]
DETAILED_HOURLY = _schema(
    ("bucket_start", TS, OPTIONAL),
    ("machine_id", TEXT, OPTIONAL),
    ("detailed_state_code", TEXT, OPTIONAL),
    ("state_tag", TEXT, OPTIONAL),
    ("sample_count", LONG, OPTIONAL),
    ("energy_kwh", DOUBLE, OPTIONAL),
    ("avg_power_kw", DOUBLE, OPTIONAL),
    ("min_power_kw", DOUBLE, OPTIONAL),
    ("max_power_kw", DOUBLE, OPTIONAL),
)

REGRESSION_BASE = _hourly(REGRESSION_BASE_COLUMNS)
REGRESSION_INPUT = _hourly(REGRESSION_INPUT_COLUMNS)

#: The hourly tables that dashboards and the regression read.
HOURLY_TABLES: dict[str, T.StructType] = {
    "state_energy_summary_hourly": _hourly(_STATE_SUMS),
    "detailed_state_energy_summary_hourly": DETAILED_HOURLY,
    "oee_energy_summary_hourly": _hourly(_OEE),
    "regression_base_hourly": REGRESSION_BASE,
}
#: Sums that log-OLS can be fitted from (`operators.moments`).
REGRESSION_MOMENTS = _schema(
    ("target", TEXT, OPTIONAL),
    ("machine_id", TEXT, OPTIONAL),
    ("day", T.DateType(), OPTIONAL),
    ("n", LONG, OPTIONAL),
    ("center", T.ArrayType(DOUBLE), OPTIONAL),
    ("cross", T.ArrayType(DOUBLE), OPTIONAL),
)
#: What an incremental refresh needs to know of earlier days.
DAY_TABLES: dict[str, T.StructType] = {"machine_day": MACHINE_DAY, "cycle_day_energy": CYCLE_DAY_ENERGY}
PUBLISHED = {**ALL_TABLES, **HOURLY_TABLES, **DAY_TABLES, "regression_moments": REGRESSION_MOMENTS}
#: The time whose day is the folder of a published row.
PARTITION_TIMES = {
    "energy_measurement": "ts",
    "machine_state_event": "ts",
    "cycle_event": "cycle_end_ts",
    "energy_enriched": "ts",
    "cycle_energy_summary": "cycle_start_ts",
    **{table: "bucket_start" for table in HOURLY_TABLES},
    **{table: "day" for table in DAY_TABLES},
    "regression_moments": "day",
}
