"""Integrity rules as queries.

Spark enforces no keys or checks, so each rule returns its violations as rows
(rule, table, key, detail); no rows means the rule holds. Whether a violation
stops a job is up to the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas
from wattline.functions import constants as k
from wattline.operators import temporal

COLUMNS = ["rule", "table", "key", "detail"]


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("NULL"))


def _key(names: Sequence[str]) -> Column:
    return F.concat_ws("|", *[_text(n) for n in names])


def _violations(df: DataFrame, rule: str, table: str, key: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table"), key.alias("key"), detail.alias("detail")
    )


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unique_key(df: DataFrame, table: str, keys: Sequence[str], rule: str = "primary_key") -> DataFrame:
    """Keys that repeat or are not filled."""
    unfilled = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter((F.col("_n") > 1) | unfilled)
    return _violations(counted, rule, table, _key(keys), F.concat(F.lit("rows="), F.col("_n")))


def primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All primary keys of the given tables; the dashboard's display order must be unique too."""
    frames = [unique_key(df, name, schemas.PRIMARY_KEYS[name]) for name, df in tables.items()]
    if "regression_dashboard_summary" in tables:
        dashboard = tables["regression_dashboard_summary"]
        frames.append(unique_key(dashboard, "regression_dashboard_summary", ["display_order"], "unique_order"))
    return _stack(frames)


def _named_values(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(name, value) of the given (name, column) pairs, stacked in one pass over the table."""
    stacked = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("value")) for n, c in pairs])
    return df.select(F.explode(stacked).alias("_v")).select("_v.*").filter(F.col("value").isNotNull())


def foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values without a parent, for all references between the given tables.

    One pass per table: a child stacks all its references and counts them per
    value first, so a hot value is one row in the join with the parents' keys.
    """
    known = [r for r in schemas.FOREIGN_KEYS if r[0] in tables and r[2] in tables]
    parents: dict[str, set[tuple[str, str]]] = {}
    children: dict[str, list[tuple[str, str]]] = {}
    for child, column, parent in known:
        parents.setdefault(parent, set()).add((parent, column))
        children.setdefault(child, []).append((parent, column))
    keys = _stack([_named_values(tables[p], sorted(columns)).distinct() for p, columns in sorted(parents.items())])
    used = _stack(
        [
            _named_values(tables[child], columns)
            .groupBy("name", "value")
            .agg(F.count("*").alias("_n"))
            .withColumn("child", F.lit(child))
            for child, columns in children.items()
        ]
    )
    # A child refers to a parent by one column, which has the parent's name for it.
    column = F.create_map(*[F.lit(x) for parent, columns in parents.items() for _, c in columns for x in (parent, c)])
    lost = used.join(keys, ["name", "value"], "left_anti")
    detail = F.concat(column[F.col("name")], F.lit("->"), F.col("name"), F.lit(" rows="), F.col("_n"))
    return lost.select(
        F.lit("foreign_key").alias("rule"), F.col("child").alias("table"), F.col("value").alias("key"), detail.alias("detail")
    )


def not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns that must be filled and are not; one pass per table."""
    frames = []
    for table, df in tables.items():
        required = [f.name for f in schemas.ALL_TABLES[table].fields if not f.nullable]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in required])
        missing = counts.select(F.explode(pairs).alias("_p")).filter("_p.n > 0")
        frames.append(
            _violations(missing, "not_null", table, F.col("_p.c"), F.concat(F.lit("nulls="), F.col("_p.n")))
        )
    return _stack(frames)


def decimal_range(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values that do not fit the declared precision; one pass per table."""
    frames = []
    for table, df in tables.items():
        wide = [
            F.when(
                F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
                F.concat(F.lit(f"{f.name} {f.dataType.simpleString()} "), F.col(f.name).cast("string")),
            )
            for f in schemas.ALL_TABLES[table].fields
            if isinstance(f.dataType, T.DecimalType)
        ]
        if wide:
            found = df.select(
                _key(schemas.PRIMARY_KEYS[table]).alias("_key"), F.explode(F.array_compact(F.array(*wide))).alias("_wide")
            )
            frames.append(_violations(found, "decimal_range", table, F.col("_key"), F.col("_wide")))
    return _stack(frames)


def check(df: DataFrame, rule: str, table: str, condition: Column, shown: str) -> DataFrame:
    """Rows for which `condition` is false; unknown passes, as in SQL CHECK."""
    return _violations(df.filter(~condition), rule, table, _key(schemas.PRIMARY_KEYS[table]), _text(shown))


def check_operation_ideal(operation: DataFrame) -> DataFrame:
    return check(
        operation, "operation_ideal", "operation", F.col("ideal_cycle_time_sec") > 0, "ideal_cycle_time_sec"
    )


def check_power(samples: DataFrame) -> DataFrame:
    return check(samples, "power", "energy_measurement", F.col("power_kw") >= 0, "power_kw")


def check_sample_interval(samples: DataFrame) -> DataFrame:
    positive = F.col("sample_interval_sec") > 0
    return check(samples, "sample_interval", "energy_measurement", positive, "sample_interval_sec")


def check_cycle_order(cycles: DataFrame) -> DataFrame:
    ordered = F.col("cycle_end_ts") > F.col("cycle_start_ts")
    return check(cycles, "cycle_order", "cycle_event", ordered, "cycle_end_ts")


def check_cycle_time(cycles: DataFrame) -> DataFrame:
    positive = F.col("actual_cycle_time_sec") > 0
    return check(cycles, "cycle_time", "cycle_event", positive, "actual_cycle_time_sec")


def check_part_result(cycles: DataFrame, summary: DataFrame) -> DataFrame:
    known = F.col("part_result").isin(k.RESULT_GOOD, k.RESULT_SCRAP)
    return _stack(
        [
            check(cycles, "part_result", "cycle_event", known, "part_result"),
            check(summary, "part_result", "cycle_energy_summary", known, "part_result"),
        ]
    )


def check_summary_order(summary: DataFrame) -> DataFrame:
    ordered = F.col("cycle_end_ts") > F.col("cycle_start_ts")
    return check(summary, "summary_order", "cycle_energy_summary", ordered, "cycle_end_ts")


def check_summary_energy(summary: DataFrame) -> DataFrame:
    positive = F.col("cycle_energy_kwh") >= 0
    return check(summary, "summary_energy", "cycle_energy_summary", positive, "cycle_energy_kwh")


def check_model_scope(dashboard: DataFrame) -> DataFrame:
    known = F.col("model_scope").isin(*k.SCOPE_TARGETS)
    return check(dashboard, "model_scope", "regression_dashboard_summary", known, "model_scope")


def overlapping_cycles(cycles: DataFrame, block: str = "day") -> DataFrame:
    """Cycles that start before an earlier cycle of the machine has ended."""
    real = cycles.filter(F.col("machine_id").isNotNull() & (F.col("cycle_end_ts") > F.col("cycle_start_ts")))
    marked = temporal.with_neighbours(real, ["machine_id"], "cycle_start_ts", "cycle_end_ts", block)
    late = marked.filter(F.col("cycle_start_ts") < F.col("_prev_end"))
    detail = F.concat(F.lit("earlier cycle ends "), _text("_prev_end"))
    return _violations(late, "overlapping_cycles", "cycle_event", _key(["cycle_id"]), detail)


def kpi_invariants(totals: DataFrame, tolerance: str = k.KPI_TOLERANCE) -> DataFrame:
    """One row per rule over the KPI totals: (rule, value, ok)."""

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(28,6)")

    ratios = ["productive_energy_ratio", "non_productive_energy_ratio"]
    parts = [
        "energy_productive_kwh",
        "energy_non_productive_kwh",
        "energy_non_productive_stop_kwh",
    ]
    amounts = [
        "energy_total_kwh",
        *parts,
        "energy_per_part_kwh",
        "cycle_energy_per_good_part_kwh",
        "energy_per_scrap_part_kwh",
        "cycle_energy_stddev_kwh",
        "system_energy_per_good_part_kwh",
    ]
    gap = reduce(lambda a, b: a + b, [exact(c) for c in parts]) - exact("energy_total_kwh")
    miscounted = F.col("good_parts") + F.col("scrap_parts") - F.col("total_parts")
    rules = [(f"{r} in [0,1]", F.col(r), F.col(r).between(0, 1)) for r in ratios]
    rules.append(("energy components sum to total", gap, F.abs(gap) <= F.lit(tolerance).cast("decimal(28,6)")))
    rules.append(("good and scrap sum to total parts", miscounted, miscounted == 0))
    rules += [(f"{a} >= 0", F.col(a), F.col(a) >= 0) for a in amounts]
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), value.cast("double").alias("value"), ok.alias("ok"))
            for rule, value, ok in rules
        ]
    )
    return totals.select(F.explode(rows).alias("_r")).select("_r.*")


class KpiValidationError(AssertionError):
    """The computed KPIs contradict each other."""


def assert_kpi_invariants(totals: DataFrame) -> None:
    """Raise when a rule fails; reads the rule rows of one totals row."""
    failed = [r["rule"] for r in kpi_invariants(totals).filter(~F.col("ok")).collect()]
    if failed:
        raise KpiValidationError("; ".join(failed))
