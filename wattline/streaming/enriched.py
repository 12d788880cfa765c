"""`energy_enriched` from a stream of samples, states and cycles.

Rows of a machine wait until the watermark has passed them, since an earlier state or cycle may
still come; then they are taken in order of time, states before samples of the same moment. State
per machine: the last reading, the last state, the cycles that have not ended, and the waiting
rows. It is bounded by the rows of one watermark delay and the cycles open at a time. Rows later than
the watermark are dropped: choose it longer than the largest delay of the feed.

A machine's rows meet in one task of each micro-batch, as its state does.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wattline.operators import temporal
from wattline.schemas import ENERGY_ENRICHED
from wattline.streaming.published import SERIES

_STATES, _CYCLES, _SAMPLES = "machine_state_event", "cycle_event", "energy_measurement"
#: At the same moment a state and a cycle that begins count for a sample.
_ORDER = {_STATES: 0, _CYCLES: 1, _SAMPLES: 2}
_OUT = (
    "micros long, machine_id string, power_kw string, counter string, interval string, has_previous boolean, "
    "previous string, detailed_state_code string, state_tag string, cycle_id string"
)


def _taken(held: dict, row: list) -> list[tuple]:
    """Apply one row to the state; a sample gives a row per cycle that contains it."""
    at, order, values = row
    if order == _ORDER[_STATES]:
        held["state"] = values
    elif order == _ORDER[_CYCLES]:
        held["cycles"].append([values[0], int(values[1]), int(values[2])])
    else:
        power, counter, interval = values
        inside = [cycle for cycle, start, end in held["cycles"] if start <= at < end]
        known = "last" in held
        out = [
            (at, power, counter, interval, known, held["last"] if known else None, *held["state"], cycle)
            for cycle in inside or [None]
        ]
        held["last"] = counter
        return out
    return []


def _enrich_machine(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = json.loads(state.get[0]) if state.exists else {"state": [None, None], "cycles": [], "waiting": []}
    watermark = state.getCurrentWatermarkMs() * 1000
    for frame in frames:
        for row in frame.itertuples(index=False):
            held["waiting"].append([int(row.micros), int(row.kind), json.loads(row.values)])
    # Of states at the same moment the largest counts, as in the batch.
    held["waiting"].sort(key=lambda row: (row[0], row[1], [value or "" for value in row[2][:2]]))
    ready = [row for row in held["waiting"] if row[0] <= watermark]
    held["waiting"] = held["waiting"][len(ready) :]
    out = [made for row in ready for made in _taken(held, row)]
    held["cycles"] = [cycle for cycle in held["cycles"] if cycle[2] > watermark]
    state.update((json.dumps(held),))
    if held["waiting"]:
        state.setTimeoutTimestamp(max(held["waiting"][0][0] // 1000, state.getCurrentWatermarkMs()) + 1)
    names = ["micros", "power_kw", "counter", "interval", "has_previous", "previous", "detailed_state_code", "state_tag", "cycle_id"]
    result = pd.DataFrame(out, columns=names)
    result.insert(1, "machine_id", key[0])
    yield result


def energy_enriched(stream: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Streaming form of `enrich.energy_enriched` over rows of `published.series_stream`; append mode."""
    series = F.col(SERIES)
    at = F.when(series == _CYCLES, F.col("cycle_start_ts")).otherwise(F.col("ts")).cast("timestamp")
    kind = F.when(series == _STATES, _ORDER[_STATES]).when(series == _CYCLES, _ORDER[_CYCLES]).otherwise(_ORDER[_SAMPLES])

    def text(*columns: Column) -> Column:
        return F.to_json(F.array(*[column.cast("string") for column in columns]))

    micros = [F.unix_micros(F.col(c).cast("timestamp")) for c in ("cycle_start_ts", "cycle_end_ts")]
    values = (
        F.when(series == _STATES, text(F.col("detailed_state_code"), F.col("state_tag")))
        .when(series == _CYCLES, text(F.col("cycle_id"), *micros))
        .otherwise(text(*[F.col(c) for c in ("power_kw", "energy_kwh_cumulative", "sample_interval_sec")]))
    )
    rows = (
        stream.filter(F.col("machine_id").isNotNull() & ((series != _CYCLES) | (F.col("cycle_end_ts") > F.col("cycle_start_ts"))))
        .select(at.alias("at"), "machine_id", kind.alias("kind"), values.alias("values"))
        .withWatermark("at", watermark)
        .withColumn("micros", F.unix_micros("at"))
    )
    joined = rows.groupBy("machine_id").applyInPandasWithState(
        _enrich_machine, _OUT, "held string", "append", GroupStateTimeout.EventTimeTimeout
    )
    kinds = {f.name: f.dataType for f in ENERGY_ENRICHED}
    counter, previous = F.col("counter").cast("decimal(12,5)"), F.col("previous").cast("decimal(12,5)")
    power, interval = F.col("power_kw").cast(kinds["power_kw"]), F.col("interval").cast("decimal(10,3)")
    delta = temporal.counter_delta(F.when(F.col("has_previous"), previous), counter, power, interval)
    return joined.select(
        F.timestamp_micros("micros").cast("timestamp_ntz").alias("ts"),
        "machine_id",
        power.alias("power_kw"),
        delta.alias("delta_energy_kwh"),
        "detailed_state_code",
        "state_tag",
        "cycle_id",
    )
