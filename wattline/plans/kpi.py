"""Hourly and multi-hour energy and OEE figures.

Sums stay DECIMAL or BIGINT (microseconds, counts) until the last step, then
one division in DOUBLE, so results do not depend on the order of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import constants as k
from wattline.functions.measures import as_double, safe_ratio, sum_where, total
from wattline.functions.timeline import hour_start, micros, micros_to_seconds, seconds_later
from wattline.operators import temporal
from wattline.operators.temporal import BLOCK, DAY_BLOCK
from wattline.schemas import REGRESSION_BASE_COLUMNS, REGRESSION_INPUT_COLUMNS

SPINE = ["bucket_start", "machine_id"]
ENERGY = [
    "energy_total_kwh",
    "energy_productive_kwh",
    "energy_non_productive_kwh",
    "energy_non_productive_stop_kwh",
]
_EPOCH = "1970-01-01 00:00:00"


def _sum_hourly(enriched: DataFrame, keys: list[str], *sums: Column) -> DataFrame:
    """Sums per machine, hour and `keys`; without a shuffle where the alignment's partitioning is there.

    An hour lies in one day, so the day that partitions the rows may be named among the keys.
    """
    hourly = enriched if BLOCK in enriched.columns else temporal.with_block(enriched, "ts")
    partitioned = [c for c in (DAY_BLOCK,) if c in hourly.columns]
    return hourly.groupBy(*SPINE, *keys, *partitioned).agg(*sums).drop(*partitioned)


def _energy_sums() -> list[Column]:
    delta, tag = F.col("delta_energy_kwh"), F.col("state_tag")
    return [
        total(delta).alias("energy_total_kwh"),
        sum_where(tag == k.TAG_PRODUCTIVE, delta).alias("energy_productive_kwh"),
        sum_where(tag == k.TAG_NON_PRODUCTIVE, delta).alias("energy_non_productive_kwh"),
        sum_where(tag == k.TAG_STOPPED, delta).alias("energy_non_productive_stop_kwh"),
    ]


def _energy_ratios() -> dict[str, Column]:
    unproductive = F.col("energy_non_productive_kwh") + F.col("energy_non_productive_stop_kwh")
    return {
        "productive_energy_ratio": safe_ratio(F.col("energy_productive_kwh"), F.col("energy_total_kwh")),
        "non_productive_energy_ratio": safe_ratio(unproductive, F.col("energy_total_kwh")),
    }


def energy_cube(enriched: DataFrame) -> DataFrame:
    """Samples summed per hour, machine, state and cycle: the one pass that all figures share.

    On aligned samples the sums need no shuffle, since (machine, day) already
    partitions them. The cube has a row per state and cycle of an hour instead
    of one per sample, and its `delta_energy_kwh` adds up like that of the
    samples. Store it before using it more than once: every consumer reads
    other columns, so Spark would not share the alignment between them.
    """
    power = F.col("power_kw")
    return _sum_hourly(
        enriched,
        ["detailed_state_code", "state_tag", "cycle_id"],
        F.sum("delta_energy_kwh").alias("delta_energy_kwh"),
        F.count("*").alias("sample_count"),
        F.count(power).alias("power_count"),
        F.sum(power).alias("power_sum"),
        F.min(power).alias("power_min"),
        F.max(power).alias("power_max"),
    )


def state_energy_summary_hourly(enriched: DataFrame) -> DataFrame:
    """Energy per machine and hour, in total and by state tag."""
    sums = _sum_hourly(enriched, [], *_energy_sums())
    return sums.withColumns(_energy_ratios()).withColumns(as_double(*ENERGY))


def detailed_state_energy_summary_hourly(enriched: DataFrame) -> DataFrame:
    """Samples, energy and power per machine, hour and state; samples without state form their own group."""
    power = F.col("power_kw")
    return _detailed(
        enriched,
        F.count("*"),
        F.sum(power),
        F.count(power),
        F.min(power),
        F.max(power),
    )


def detailed_from_cube(cube: DataFrame) -> DataFrame:
    """The same view from the cube."""
    return _detailed(
        cube,
        F.sum("sample_count"),
        F.sum("power_sum"),
        F.sum("power_count"),
        F.min("power_min"),
        F.max("power_max"),
    )


def _detailed(
    rows: DataFrame, samples: Column, power_sum: Column, power_count: Column, smallest: Column, largest: Column
) -> DataFrame:
    return _sum_hourly(
        rows,
        ["detailed_state_code", "state_tag"],
        samples.alias("sample_count"),
        total(F.col("delta_energy_kwh")).cast("double").alias("energy_kwh"),
        safe_ratio(power_sum, power_count).alias("avg_power_kw"),
        F.coalesce(smallest.cast("double"), F.lit(0.0)).alias("min_power_kw"),
        F.coalesce(largest.cast("double"), F.lit(0.0)).alias("max_power_kw"),
    )


def all_machines(machine: DataFrame, samples: DataFrame, states: DataFrame, cycles: DataFrame) -> DataFrame:
    """Every machine known to any table. Each table is reduced before the union."""
    tables = [df.select("machine_id").distinct() for df in (machine, samples, states, cycles)]
    return reduce(DataFrame.unionByName, tables).distinct()


def machine_time_bounds(
    machine: DataFrame, samples: DataFrame, states: DataFrame, cycles: DataFrame
) -> DataFrame:
    """The latest moment anything is known about a machine, 1970 when nothing is."""
    kind = states.schema["ts"].dataType
    sample_end = seconds_later(F.col("ts"), F.coalesce("sample_interval_sec", F.lit(0)))
    ends = [
        samples.groupBy("machine_id").agg(F.max(sample_end).alias("_end")),
        states.groupBy("machine_id").agg(F.max("ts").alias("_end")),
        cycles.groupBy("machine_id").agg(F.max("cycle_end_ts").alias("_end")),
        machine.select("machine_id").distinct().withColumn("_end", F.lit(None).cast(kind)),
    ]
    return (
        reduce(DataFrame.unionByName, ends)
        .groupBy("machine_id")
        .agg(F.greatest(F.max("_end"), F.lit(_EPOCH).cast(kind)).alias("max_bound_ts"))
    )


def bounds_join(states: DataFrame, bounds: DataFrame) -> DataFrame:
    """State events with the time bound of their machine, before intervals are formed."""
    return states.join(bounds, "machine_id").select("machine_id", "ts", "detailed_state_code", "max_bound_ts")


def state_intervals(states: DataFrame, bounds: DataFrame, block: str = "day") -> DataFrame:
    """How long each reported state lasted; empty ones are dropped."""
    events = states.select(
        "machine_id",
        F.col("ts").alias("start_ts"),
        "detailed_state_code",
        "state_tag",
        "reason_code",
        "is_planned_stop",
        "idle_reason",
    )
    intervals = temporal.to_intervals(events, ["machine_id"], "start_ts", "end_ts", bounds, "max_bound_ts", block)
    return intervals.filter(F.col("end_ts") > F.col("start_ts"))


def lateral_hours(intervals: DataFrame) -> DataFrame:
    """One row per interval and hour it touches."""
    return intervals.withColumn(BLOCK, F.explode(temporal.blocks_touched(intervals, "start_ts", "end_ts")))


def state_interval_bucketed(intervals: DataFrame) -> DataFrame:
    """State intervals cut at hour borders."""
    pieces = temporal.split_by_hour(intervals.drop("reason_code"), "start_ts", "end_ts")
    return pieces.select(
        "machine_id",
        "bucket_start",
        "interval_start",
        "interval_end",
        "detailed_state_code",
        "state_tag",
        "is_planned_stop",
        "idle_reason",
    )


def _state_time_micros(bucketed: DataFrame) -> DataFrame:
    """Planned and lost microseconds; a stop of unknown planning counts as neither."""
    length = micros("interval_end") - micros("interval_start")
    planned = ~F.col("is_planned_stop")
    lost = (
        (F.col("detailed_state_code") == k.STATE_FAILURE)
        | (F.col("state_tag") == k.TAG_STOPPED)
        | ((F.col("detailed_state_code") == k.STATE_IDLE) & F.col("idle_reason").eqNullSafe(k.REASON_WAITING))
    )
    return (
        bucketed.filter(F.col("interval_end") > F.col("interval_start"))
        .groupBy(*SPINE)
        .agg(
            F.sum(F.when(planned, length).otherwise(0)).alias("_planned_micros"),
            F.sum(F.when(planned & lost, length).otherwise(0)).alias("_loss_micros"),
        )
    )


def _state_seconds(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "planned_time_sec": micros_to_seconds(F.col("_planned_micros")),
            "availability_loss_sec": micros_to_seconds(F.col("_loss_micros")),
        }
    ).drop("_planned_micros", "_loss_micros")


def state_time_hourly(bucketed: DataFrame) -> DataFrame:
    """Planned time and availability loss per machine and hour, in seconds."""
    return _state_seconds(_state_time_micros(bucketed))


def cycle_operation_join(cycles: DataFrame, operation: DataFrame) -> DataFrame:
    """Cycles with the ideal time of their operation; cycles of unknown operations are dropped."""
    return cycles.join(operation.select("operation_id", "ideal_cycle_time_sec"), "operation_id").select(
        "cycle_id", "machine_id", "operation_id", "ideal_cycle_time_sec", "actual_cycle_time_sec"
    )


def cycle_summary_left_join(cycles: DataFrame, summary: DataFrame) -> DataFrame:
    """Cycles with their energy; NULL when the summary does not know the cycle."""
    return cycles.join(summary.select("cycle_id", "cycle_energy_kwh"), "cycle_id", "left").select(
        "cycle_id",
        "machine_id",
        "operation_id",
        "cycle_start_ts",
        "actual_cycle_time_sec",
        "part_result",
        "cycle_energy_kwh",
    )


_CYCLE_SUMS = [
    "ideal_cycle_time_total_sec",
    "actual_cycle_time_total_sec",
    "total_cycle_energy_kwh",
    "good_cycle_energy_kwh",
    "scrap_cycle_energy_kwh",
]


def cycle_stats_of(cycles: DataFrame, operation: DataFrame) -> DataFrame:
    """The hourly cycle figures from cycles that already carry their energy.

    Cycles are summed per hour, machine and operation first. The join with the
    operations then meets one row per such group, so a very common operation
    does not gather its cycles in one task.
    """
    good, scrap = F.col("part_result") == k.RESULT_GOOD, F.col("part_result") == k.RESULT_SCRAP
    energy = F.col("cycle_energy_kwh")
    per_operation = (
        cycles.withColumn(BLOCK, hour_start(cycles, "cycle_start_ts"))
        .groupBy(*SPINE, "operation_id")
        .agg(
            F.count("*").alias("total_parts"),
            F.count_if(good).alias("good_parts"),
            F.count_if(scrap).alias("scrap_parts"),
            F.sum("actual_cycle_time_sec").alias("actual_cycle_time_total_sec"),
            F.sum(energy).alias("total_cycle_energy_kwh"),
            F.sum(F.when(good, energy)).alias("good_cycle_energy_kwh"),
            F.sum(F.when(scrap, energy)).alias("scrap_cycle_energy_kwh"),
        )
    )
    ideal = F.col("ideal_cycle_time_sec") * F.col("total_parts").cast("decimal(18,0)")
    return (
        per_operation.join(operation.select("operation_id", "ideal_cycle_time_sec"), "operation_id")
        .withColumn("ideal_cycle_time_total_sec", ideal)
        .groupBy(*SPINE)
        .agg(
            *[F.sum(c).alias(c) for c in ("total_parts", "good_parts", "scrap_parts")],
            *[total(F.col(c).cast("decimal(28,6)")).cast("double").alias(c) for c in _CYCLE_SUMS],
        )
    )


def cycle_stats_hourly(cycles: DataFrame, operation: DataFrame, summary: DataFrame) -> DataFrame:
    """Parts, cycle times and cycle energy by the hour in which the cycle started."""
    return cycle_stats_of(cycle_summary_left_join(cycles, summary), operation)


def all_buckets(energy: DataFrame, state_time: DataFrame, cycle_stats: DataFrame) -> DataFrame:
    """Every (hour, machine) that any hourly table knows."""
    return reduce(
        DataFrame.unionByName, [df.select(*SPINE) for df in (energy, state_time, cycle_stats)]
    ).distinct()


def spine_left_joins(energy: DataFrame, state_time: DataFrame, cycle_stats: DataFrame) -> DataFrame:
    """The three hourly tables side by side on every (hour, machine); NULL where one has no row.

    Each table has at most one row per (hour, machine). Stacking them and
    taking the only value of each column is the distinct union left-joined
    three times, with one shuffle instead of four.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [energy, state_time, cycle_stats]
    )
    values = [c for c in stacked.columns if c not in SPINE]
    return stacked.groupBy(*SPINE).agg(*[F.max(c).alias(c) for c in values])


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _availability() -> Column:
    planned = F.col("planned_time_sec")
    return safe_ratio(planned - _or_zero("availability_loss_sec"), planned)


def _performance() -> Column:
    return safe_ratio(F.col("ideal_cycle_time_total_sec"), F.col("actual_cycle_time_total_sec"))


def _quality() -> Column:
    return safe_ratio(F.col("good_parts"), F.col("total_parts"))


def _with_oee(df: DataFrame) -> DataFrame:
    parts = df.withColumns(
        {"availability": _availability(), "performance": _performance(), "quality": _quality()}
    )
    return parts.withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))


def _energy_per_good_part() -> dict[str, Column]:
    return {
        "cycle_energy_per_good_part_kwh": safe_ratio(F.col("good_cycle_energy_kwh"), F.col("good_parts")),
        "system_energy_per_good_part_kwh": safe_ratio(F.col("energy_total_kwh"), F.col("good_parts")),
    }


def oee_energy_summary_hourly(energy: DataFrame, state_time: DataFrame, cycle_stats: DataFrame) -> DataFrame:
    """OEE components and energy per part for every (hour, machine)."""
    return oee_of_spine(spine_left_joins(energy, state_time, cycle_stats))


def oee_of_spine(joined: DataFrame) -> DataFrame:
    """The same from the joined spine."""
    spine = _with_oee(joined)
    per_good = _energy_per_good_part()
    return spine.select(
        *SPINE,
        "availability",
        "performance",
        "quality",
        "oee",
        safe_ratio(F.col("total_cycle_energy_kwh"), F.col("total_parts")).alias("energy_per_part_kwh"),
        per_good["cycle_energy_per_good_part_kwh"].alias("energy_per_good_part_kwh"),
        *[column.alias(name) for name, column in per_good.items()],
        safe_ratio(F.col("scrap_cycle_energy_kwh"), F.col("scrap_parts")).alias("energy_per_scrap_part_kwh"),
        F.coalesce("energy_total_kwh", F.lit(0.0)).alias("energy_total_kwh"),
    )


def _with_ratios(df: DataFrame) -> DataFrame:
    return _with_oee(df).withColumns(
        {
            "scrap_rate": safe_ratio(F.col("scrap_parts"), F.col("total_parts")),
            **_energy_per_good_part(),
            "non_productive_energy_ratio": _energy_ratios()["non_productive_energy_ratio"],
        }
    )


def regression_base_hourly(energy: DataFrame, state_time: DataFrame, cycle_stats: DataFrame) -> DataFrame:
    """Components and ratios for every (hour, machine), 0 where nothing is known."""
    return regression_base_of_spine(spine_left_joins(energy, state_time, cycle_stats))


def regression_base_of_spine(spine: DataFrame) -> DataFrame:
    """The same from the joined spine."""
    counts = ["total_parts", "good_parts", "scrap_parts"]
    sums = [
        "planned_time_sec",
        "availability_loss_sec",
        "ideal_cycle_time_total_sec",
        "actual_cycle_time_total_sec",
        "good_cycle_energy_kwh",
        *ENERGY,
    ]
    filled = spine.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts},
            **{c: F.coalesce(c, F.lit(0.0)) for c in sums},
        }
    )
    return _with_ratios(filled).select(*REGRESSION_BASE_COLUMNS)


def aggregate_regression_input(
    base: DataFrame, hours: int = k.AGGREGATION_HOURS, min_good: int = k.MIN_GOOD_PARTS
) -> DataFrame:
    """Roll hours up to UTC-aligned windows and compute the ratios again from the sums."""
    sums = [
        "planned_time_sec",
        "availability_loss_sec",
        "ideal_cycle_time_total_sec",
        "actual_cycle_time_total_sec",
        "good_cycle_energy_kwh",
        *ENERGY,
    ]
    rolled = (
        base.filter(F.col("bucket_start").isNotNull() & F.col("machine_id").isNotNull())
        .groupBy(F.window("bucket_start", f"{hours} hours").alias("_window"), "machine_id")
        .agg(
            *[
                F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
                for c in ("total_parts", "good_parts", "scrap_parts")
            ],
            # decimals make the sums independent of row order
            *[total(F.col(c).cast("decimal(28,6)")).alias(c) for c in sums],
        )
        .withColumn("bucket_start", F.col("_window.start"))
    )
    return (
        _with_ratios(rolled.withColumns(as_double(*sums)))
        .filter(F.col("good_parts") >= min_good)
        .select(*REGRESSION_INPUT_COLUMNS)
    )


def target_profile(regression_input: DataFrame, targets: list[str] = k.TARGETS) -> DataFrame:
    """Smallest, largest and mean value of each regression target.

    The mean is taken from a DECIMAL sum (12 digits after the point), so it does not depend on the order of rows.
    """
    long = regression_input.select(
        F.explode(
            F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("value")) for t in targets])
        ).alias("_t")
    ).select("_t.target", "_t.value")
    mean = F.sum(F.col("value").cast("decimal(28,12)")).cast("double") / F.count("value").cast("double")
    return long.groupBy("target").agg(
        F.min("value").alias("min_value"), F.max("value").alias("max_value"), mean.alias("mean_value")
    )


def _exact_stddev(value: Column) -> Column:
    """Population deviation of DECIMAL(12,6) values from exact power sums; 0 without values.

    The sums are moved in DECIMAL to a centre near the mean, so neither the order of rows nor large
    values close together cost digits. ANSI casts stop the query where the sums leave their range
    (10^13 rows, 10^19 kWh).
    """
    x = value.cast("decimal(12,6)")
    n, total_, squares = F.count(x), F.sum(x).cast("decimal(25,6)"), F.sum((x * x).cast("decimal(24,12)"))
    rows = n.cast("decimal(13,0)")
    centre = F.when(n > 0, F.round(total_ / rows, 6)).otherwise(F.lit(0)).cast("decimal(12,6)")

    def wide(term: Column) -> Column:
        return term.cast("decimal(37,12)")

    half = wide(total_ * centre) - wide(rows * (centre * centre).cast("decimal(24,12)"))
    around = wide(wide(squares) - wide(total_ * centre)) - wide(half)
    off = (total_ - (rows * centre).cast("decimal(25,6)")).cast("double") / n.cast("double")
    variance = around.cast("double") / n.cast("double") - off * off
    return F.when(n > 0, F.sqrt(F.greatest(variance, F.lit(0.0)))).otherwise(F.lit(0.0))


def kpi_cross_join(enriched: DataFrame, summary: DataFrame) -> DataFrame:
    """Totals of samples and of cycles on one row; two one-row results are put side by side."""
    good, scrap = F.col("part_result") == k.RESULT_GOOD, F.col("part_result") == k.RESULT_SCRAP
    energy = F.col("cycle_energy_kwh")
    samples = enriched.agg(*_energy_sums())
    cycles = summary.agg(
        F.count("*").alias("total_parts"),
        F.count_if(good).alias("good_parts"),
        F.count_if(scrap).alias("scrap_parts"),
        total(energy).alias("total_cycle_energy_kwh"),
        sum_where(good, energy).alias("good_cycle_energy_kwh"),
        sum_where(scrap, energy).alias("scrap_cycle_energy_kwh"),
        _exact_stddev(energy).alias("cycle_energy_stddev_kwh"),
    )
    both = samples.unionByName(cycles, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def kpi_totals(enriched: DataFrame, summary: DataFrame) -> DataFrame:
    """Energy, parts and energy per part over everything; one row."""
    both = kpi_cross_join(enriched, summary)
    return both.select(
        *[F.col(c).cast("double").alias(c) for c in ENERGY],
        *[column.alias(name) for name, column in _energy_ratios().items()],
        "total_parts",
        "good_parts",
        "scrap_parts",
        safe_ratio(F.col("total_cycle_energy_kwh"), F.col("total_parts")).alias("energy_per_part_kwh"),
        safe_ratio(F.col("good_cycle_energy_kwh"), F.col("good_parts")).alias("cycle_energy_per_good_part_kwh"),
        safe_ratio(F.col("scrap_cycle_energy_kwh"), F.col("scrap_parts")).alias("energy_per_scrap_part_kwh"),
        "cycle_energy_stddev_kwh",
        safe_ratio(F.col("energy_total_kwh"), F.col("good_parts")).alias("system_energy_per_good_part_kwh"),
    )
