"""Samples joined to meter deltas, machine states and production cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators import temporal
from wattline.operators.temporal import BLOCK, DAY_BLOCK, Lookup
from wattline.schemas import CYCLE_ENERGY_SUMMARY, ENERGY_ENRICHED

BY = ["machine_id"]
STATE_COLUMNS = ["detailed_state_code", "state_tag"]
CYCLE_TIMES = ("cycle_start_ts", "cycle_end_ts")


def lag_counter(samples: DataFrame, block: str = "day") -> DataFrame:
    """The previous counter reading of the machine; a NULL reading is not skipped."""
    out = temporal.previous_row(samples, BY, "ts", {"energy_kwh_cumulative": "prev_energy_kwh"}, block)
    return out.select("ts", "machine_id", "energy_kwh_cumulative", "prev_energy_kwh")


def _delta(previous: str):
    return temporal.counter_delta(
        F.col(previous), F.col("energy_kwh_cumulative"), F.col("power_kw"), F.col("sample_interval_sec")
    )


def delta_energy(samples: DataFrame, block: str = "day") -> DataFrame:
    """Energy used since the previous sample, as stored: decimal(12,6)."""
    out = temporal.previous_row(samples, BY, "ts", {"energy_kwh_cumulative": "prev_energy_kwh"}, block)
    return out.select("ts", "machine_id", "power_kw", _delta("prev_energy_kwh").alias("delta_energy_kwh"))


def asof_state_join(samples: DataFrame, states: DataFrame, block: str = "day") -> DataFrame:
    """The state each sample falls into; NULL before the first state of the machine."""
    out = temporal.asof_join(samples.select("ts", "machine_id"), states, BY, "ts", "ts", STATE_COLUMNS, block)
    return out.select("ts", "machine_id", *STATE_COLUMNS)


def interval_cycle_join(samples: DataFrame, cycles: DataFrame, block: str = "day") -> DataFrame:
    """The cycles each sample falls into, half-open; NULL outside of cycles."""
    out = temporal.interval_join(
        samples.select("ts", "machine_id"), cycles, BY, "ts", *CYCLE_TIMES, ["cycle_id"], block
    )
    return out.select("ts", "machine_id", "cycle_id")


def enriched_by_hour(
    samples: DataFrame, states: DataFrame, cycles: DataFrame, block: str = "day", by: Sequence[str] = BY
) -> DataFrame:
    """`energy_enriched` plus its hour `bucket_start`, partitioned by (machine, day).

    Meter lag, state and cycle come from one common sort, and hourly sums of
    the result need no further shuffle: the day stays as a column of its own. With blocks
    below the hour, hourly sums shuffle their partial results. `by` names further
    keys that keep series apart, beside `machine_id`.
    """
    further = [key for key in by if key not in BY]
    prepared = temporal.prepare_intervals(cycles, by, *CYCLE_TIMES, ["cycle_id"], block)
    aligned = temporal.latest_values(
        samples,
        by,
        "ts",
        lookups=[
            Lookup("_state", states, "ts", STATE_COLUMNS),
            temporal.interval_lookup("_cycle", prepared, *CYCLE_TIMES, ["cycle_id"]),
        ],
        previous=("_prev", ["energy_kwh_cumulative"]),
        block=block,
    )
    out = aligned.select(
        BLOCK,
        "ts",
        "machine_id",
        *further,
        "power_kw",
        _delta("_prev.energy_kwh_cumulative").alias("delta_energy_kwh"),
        *[F.col(f"_state.{c}").alias(c) for c in STATE_COLUMNS],
        "_cycle",
    )
    joined = temporal.finish_interval_join(out, "_cycle", prepared, by, "ts", *CYCLE_TIMES, ["cycle_id"])
    if block == "hour":
        return joined
    return temporal.with_block(joined.withColumnRenamed(BLOCK, DAY_BLOCK) if block == "day" else joined, "ts")


def energy_enriched(
    samples: DataFrame, states: DataFrame, cycles: DataFrame, block: str = "day"
) -> DataFrame:
    """One row per sample (and containing cycle) with delta, state and cycle."""
    return enriched_by_hour(samples, states, cycles, block).select(*ENERGY_ENRICHED.names)


def cycle_energy_join(cycles: DataFrame, enriched: DataFrame) -> DataFrame:
    """Each cycle with the samples inside it; a cycle without samples stays, with NULLs.

    The samples already know their cycle, so only the cycles without samples
    have to be found: an anti join against the distinct cycles met.
    """
    inside = enriched.filter(F.col("cycle_id").isNotNull()).select("cycle_id", "ts", "delta_energy_kwh")
    empty = cycles.select("cycle_id").join(inside.select("cycle_id").distinct(), "cycle_id", "left_anti")
    return inside.unionByName(empty, allowMissingColumns=True)


def cycles_with_energy(cycles: DataFrame, enriched: DataFrame) -> DataFrame:
    """Cycles and the energy used in each, 0 when no sample falls into it."""
    used = (
        enriched.filter(F.col("cycle_id").isNotNull())
        .groupBy("cycle_id")
        .agg(F.sum("delta_energy_kwh").alias("_energy"))
    )
    energy = F.coalesce("_energy", F.lit(0)).cast("decimal(12,6)")
    return cycles.join(used, "cycle_id", "left").withColumn("cycle_energy_kwh", energy).drop("_energy")


def cycle_energy_summary(cycles: DataFrame, enriched: DataFrame) -> DataFrame:
    """Energy per cycle in the shape of the stored table."""
    return cycles_with_energy(cycles, enriched).select(*CYCLE_ENERGY_SUMMARY.names)


def preview_enriched(enriched: DataFrame, rows: int = 10) -> DataFrame:
    return enriched.orderBy("ts", "machine_id").limit(rows)


def preview_cycles(summary: DataFrame, rows: int = 10) -> DataFrame:
    return summary.orderBy("cycle_start_ts", "cycle_id").limit(rows)


def row_counts(enriched: DataFrame, summary: DataFrame) -> DataFrame:
    """Rows of the two derived tables."""
    return (
        enriched.agg(F.count("*").alias("row_count"))
        .withColumn("table_name", F.lit("energy_enriched"))
        .unionByName(
            summary.agg(F.count("*").alias("row_count")).withColumn(
                "table_name", F.lit("cycle_energy_summary")
            )
        )
        .select("table_name", "row_count")
    )
