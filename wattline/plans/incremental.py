"""Published tables kept up to date from new rows, without a rebuild.

What a day's rows need from before the day is a few values per machine: its last meter reading,
its last state and the cycles that run over the end of a day. `machine_day` holds them, one row
per machine and day, and `cycle_day_energy` how much energy each cycle used on each of its days.
With both, any day can be computed anew from its own rows. `refresh` adds rows to the base tables
and replaces the days that they reach:

- a sample changes its own day, and the next day with samples of its machine if it is the last of
  its day (the meter delta there looks back to it);
- a state changes its day and all days up to the next state of its machine, or to the latest moment
  known of it; a later such moment prolongs the machine's last state;
- a cycle changes the days it runs over, and the day it starts on, where its energy is booked;
- samples that changed also change the start days of the cycles that contain them.

Everything is one publication: readers see all days of before or all days of after. Lists of days
and of machines' days reach the driver or a task as calendar-bounded lists, rows never do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions.timeline import seconds_later
from wattline.operators import temporal
from wattline.plans import enrich, kpi
from wattline.session import cut_lineage
from wattline.sources import sinks, store

#: The base tables that grow, with the time whose day a row belongs to.
SERIES = ("energy_measurement", "machine_state_event", "cycle_event")
DAY = "_day"
KEYS = ["machine_id", DAY]
_CYCLE = [c for c in schemas.CYCLE_EVENT.names if c != "machine_id"]


def _day_of(ts: str) -> Column:
    return F.to_date(ts)


def _merged(frames: Sequence[DataFrame]) -> DataFrame:
    """Partial rows of machine days put together; the last of its kind wins."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy("machine_id", "day").agg(
        # A struct begins with its time.
        F.max("last_sample").alias("last_sample"),
        F.max("last_state").alias("last_state"),
        F.max("max_end").alias("max_end"),
        F.flatten(F.collect_list("running")).alias("running"),
    )


def machine_days(samples: DataFrame, states: DataFrame, cycles: DataFrame) -> DataFrame:
    """What later days need to know of each machine and day (schema `schemas.MACHINE_DAY`).

    `running` holds the cycles that began on the day or before and end on a later one.
    """
    kind = states.schema["ts"].dataType
    sample_end = seconds_later(F.col("ts"), F.coalesce("sample_interval_sec", F.lit(0))).cast(kind)
    crossing = cycles.filter(_day_of("cycle_start_ts") < _day_of("cycle_end_ts"))
    days_run = F.sequence(_day_of("cycle_start_ts"), F.date_sub(_day_of("cycle_end_ts"), 1))
    parts = [
        samples.groupBy("machine_id", _day_of("ts").alias("day")).agg(
            F.max(F.struct("ts", "energy_kwh_cumulative")).alias("last_sample"), F.max(sample_end).alias("max_end")
        ),
        states.groupBy("machine_id", _day_of("ts").alias("day")).agg(
            F.max(F.struct("ts", "detailed_state_code", "state_tag", "is_planned_stop", "idle_reason")).alias("last_state"),
            F.max("ts").alias("max_end"),
        ),
        cycles.groupBy("machine_id", _day_of("cycle_end_ts").alias("day")).agg(F.max("cycle_end_ts").alias("max_end")),
        crossing.select("machine_id", F.explode(days_run).alias("day"), F.struct(*_CYCLE).alias("one"))
        .groupBy("machine_id", "day")
        .agg(F.collect_list("one").alias("running")),
    ]
    named = [part.filter(F.col("machine_id").isNotNull() & F.col("day").isNotNull()) for part in parts]
    return _merged(named).select(*schemas.MACHINE_DAY.names)


def cycle_day_energy(enriched: DataFrame) -> DataFrame:
    """Energy of each cycle on each day (schema `schemas.CYCLE_DAY_ENERGY`)."""
    inside = enriched.filter(F.col("cycle_id").isNotNull())
    energy = F.sum("delta_energy_kwh").cast("decimal(22,6)").alias("energy_kwh")
    return inside.groupBy(_day_of("ts").alias("day"), "cycle_id").agg(energy)


def publish_days(spark: SparkSession, directory: str) -> None:
    """Publish `machine_day` and `cycle_day_energy` beside rebuilt tables; `refresh` begins from there."""
    with store.publication(spark, directory) as staged:
        staged.write("machine_day", machine_days(*[staged.read(t) for t in ("energy_measurement", "machine_state_event", "cycle_event")]))
        staged.write("cycle_day_energy", cycle_day_energy(staged.read("energy_enriched")))


# -- which days ----------------------------------------------------------------------------------


def _next_day(days: DataFrame, column: str) -> DataFrame:
    """(machine_id, day, column, next): the days on which `column` is known, each with the next such day."""
    known = days.filter(F.col(column).isNotNull())
    following = F.lead("day").over(Window.partitionBy("machine_id").orderBy("day"))
    return known.select("machine_id", "day", column, following.alias("next"))


def _later_tails(added: DataFrame, before: DataFrame, column: str) -> DataFrame:
    """(machine_id, day) whose last sample or state is a new one."""
    old = before.select("machine_id", "day", F.col(f"{column}.ts").alias("held"))
    new = added.filter(F.col(column).isNotNull()).join(old, ["machine_id", "day"], "left")
    return new.filter(F.col("held").isNull() | (F.col(f"{column}.ts") > F.col("held"))).select("machine_id", "day")


def _bounds(days: DataFrame) -> DataFrame:
    return days.groupBy("machine_id").agg(F.max("max_end").alias("bound"))


def reached_days(new: Mapping[str, DataFrame], added: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """(kind, machine_id, day): days whose samples, state times or cycle energies change.

    `added`, `before` and `after` are the machine days of the new rows, of the old ones and of all.
    """
    sampled = after.filter(F.col("last_sample").isNotNull()).select("machine_id", "day")
    states, cycles = new["machine_state_event"], new["cycle_event"]

    own = new["energy_measurement"].select("machine_id", _day_of("ts").alias("day"))
    following = (
        _next_day(after, "last_sample").join(_later_tails(added, before, "last_sample"), ["machine_id", "day"])
        .filter(F.col("next").isNotNull())
        .select("machine_id", F.col("next").alias("day"))
    )

    stated = states.select("machine_id", _day_of("ts").alias("day"))
    bound_now, bound_then = _bounds(after), _bounds(before).withColumnRenamed("bound", "bound_before")
    lasting = (
        _next_day(after, "last_state")
        .join(_later_tails(added, before, "last_state"), ["machine_id", "day"])
        .join(bound_now, "machine_id")
        .withColumn("last", F.greatest("day", F.coalesce("next", F.to_date("bound"))))
        .select("machine_id", F.explode(F.sequence("day", "last")).alias("day"))
    )
    prolonged = (
        bound_now.join(bound_then, "machine_id")
        .filter(F.col("bound") > F.col("bound_before"))
        .select("machine_id", F.explode(F.sequence(F.to_date("bound_before"), F.to_date("bound"))).alias("day"))
    )

    over = cycles.select("machine_id", F.explode(F.sequence(_day_of("cycle_start_ts"), _day_of("cycle_end_ts"))).alias("day"))
    begun = cycles.select("machine_id", _day_of("cycle_start_ts").alias("day"))

    kinds = {
        "samples": own.unionByName(following).unionByName(stated.unionByName(lasting).unionByName(over).join(sampled, ["machine_id", "day"], "left_semi")),
        "states": stated.unionByName(lasting).unionByName(prolonged),
        "cycles": begun,
    }
    tagged = [df.distinct().withColumn("kind", F.lit(kind)) for kind, df in kinds.items()]
    return reduce(DataFrame.unionByName, tagged)


def _days(df: DataFrame, column: str = "day") -> list[str]:
    """Days as text, in order: at most as many as the calendar has."""
    return sorted(str(row[0]) for row in df.select(column).distinct().collect() if row[0] is not None)


def _array_of(days: Iterable[str]) -> Column:
    return F.array(*[F.lit(day) for day in days]).cast("array<date>")


# -- rows of days --------------------------------------------------------------------------------


def _carried(after: DataFrame, column: str, days: Sequence[str]) -> DataFrame:
    """(machine_id, _day, the fields of `column`): the last known value before each of `days`."""
    wanted = F.filter(
        _array_of(days), lambda day: (day > F.col("day")) & (F.col("next").isNull() | (day <= F.col("next")))
    )
    # Fields of their own: the optimizer loses fields of a struct that passes an explode.
    known = _next_day(after, column).select("machine_id", "day", "next", f"{column}.*")
    return known.select(*[c for c in known.columns if c not in ("day", "next")], F.explode(wanted).alias(DAY))


def _cycles_over(staged: store.Publication, after: DataFrame, days: Sequence[str]) -> DataFrame:
    """Cycles that have a part on each of `days`, with the day: those that end on it and those that run on."""
    names = schemas.CYCLE_EVENT.names
    ending = staged.read("cycle_event", days).select(*names, _day_of("cycle_end_ts").alias(DAY))
    running = after.filter(F.col("day").isin(*[date.fromisoformat(day) for day in days]))
    running = running.select("machine_id", F.col("day").alias(DAY), F.inline("running"))
    return ending.unionByName(running.select(*names, DAY))


def _enriched(staged: store.Publication, after: DataFrame, days: Sequence[str]) -> DataFrame:
    """`energy_enriched` with its hour, of whole days, from the rows of these days and carried values."""
    samples = staged.read("energy_measurement", days).withColumn(DAY, _day_of("ts"))
    before = _carried(after, "last_sample", days)
    states = staged.read("machine_state_event", days).select("ts", "machine_id", *enrich.STATE_COLUMNS, _day_of("ts").alias(DAY))
    held = _carried(after, "last_state", days).select("ts", "machine_id", *enrich.STATE_COLUMNS, DAY)
    rows = enrich.enriched_by_hour(
        samples.unionByName(before, allowMissingColumns=True),
        states.unionByName(held),
        _cycles_over(staged, after, days),
        by=KEYS,
    )
    return rows.filter(_day_of("ts") == F.col(DAY)).drop(DAY)


def _state_time(staged: store.Publication, after: DataFrame, days: Sequence[str]) -> DataFrame:
    """`kpi.state_time_hourly` of whole days: a day begins with the state that lasted into it."""
    names = ["detailed_state_code", "state_tag", "is_planned_stop", "idle_reason"]
    kind = schemas.TS
    midnight = F.col(DAY).cast(kind)
    states = staged.read("machine_state_event", days)
    events = states.select("machine_id", _day_of("ts").alias(DAY), F.col("ts").alias("start_ts"), *names)
    held = _carried(after, "last_state", days).select(*KEYS, F.col("ts").alias("start_ts"), *names)
    ends = _bounds(after).select("machine_id", "bound", F.explode(_array_of(days)).alias(DAY))
    ends = ends.select(*KEYS, F.least(F.col("bound"), F.date_add(DAY, 1).cast(kind)).alias("bound"))
    intervals = temporal.to_intervals(events.unionByName(held), KEYS, "start_ts", "end_ts", ends, "bound")
    inside = intervals.withColumn("start_ts", F.greatest("start_ts", midnight)).filter(F.col("end_ts") > F.col("start_ts"))
    return kpi.state_time_hourly(kpi.state_interval_bucketed(inside.drop(DAY)))


def _begun(staged: store.Publication, after: DataFrame, days: Sequence[str]) -> DataFrame:
    """The cycles that start on `days`."""
    over = _cycles_over(staged, after, days)
    return over.filter(_day_of("cycle_start_ts") == F.col(DAY)).drop(DAY)


# -- refresh -------------------------------------------------------------------------------------


def refresh(
    spark: SparkSession,
    directory: str,
    rows: Mapping[str, DataFrame],
    violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
    note: tuple[str, int] | None = None,
) -> store.Snapshot:
    """Add rows to the series of a published plant and replace the days that they reach.

    `rows` holds new samples, states and cycles by table name; they may be of any age. `violations`
    sees the base tables' changed days and may reject the refresh. With `note` (a name and a number)
    the publication remembers the number, and a refresh that is not above it changes nothing.
    """
    unknown = set(rows) - set(SERIES)
    if unknown:
        raise ValueError(f"rows of {sorted(unknown)} cannot be added")
    if note is not None and store.snapshot(spark, directory).notes.get(note[0], -1) >= note[1]:
        return store.snapshot(spark, directory)
    with store.publication(spark, directory) as staged:
        if "machine_day" not in staged.base.tables:
            raise FileNotFoundError(f"{directory} has no machine days; run publish_days")
        if note is not None:
            staged.notes[note[0]] = note[1]
        _refresh(spark, staged, rows, violations)
    return store.snapshot(spark, directory)


def _refresh(spark: SparkSession, staged: store.Publication, rows, violations) -> None:
    new = {
        table: cut_lineage(rows[table].select(*schemas.BASE_TABLES[table].names), f"new_{table}")
        if table in rows
        else spark.createDataFrame([], schemas.BASE_TABLES[table])
        for table in SERIES
    }
    added = cut_lineage(machine_days(*[new[t] for t in SERIES]), "added_days")
    reached = _days(added)
    if not reached:
        return
    before = staged.base.read("machine_day")
    held = staged.base.read("machine_day", reached)
    staged.write_days("machine_day", _merged([held, added]), reached)
    after = staged.read("machine_day")

    changed = {}
    for table in SERIES:
        days = _days(new[table].select(_day_of(schemas.PARTITION_TIMES[table]).alias("day")))
        if days:
            both = staged.base.read(table, days).unionByName(new[table])
            staged.write_days(table, both, days)
            changed[table] = staged.read(table, days)
    if violations is not None:
        store.reject(violations(changed))

    kinds = cut_lineage(reached_days(new, added, before, after), "reached_days")
    by_kind = {kind: _days(kinds.filter(F.col("kind") == kind)) for kind in ("samples", "states", "cycles")}
    sampled = by_kind["samples"]
    starts = set(by_kind["cycles"])
    if sampled:
        staged.write_days("energy_enriched", _enriched(staged, after, sampled).select(*schemas.ENERGY_ENRICHED.names), sampled)
        enriched = staged.read("energy_enriched", sampled)
        staged.write_days("cycle_day_energy", cycle_day_energy(enriched), sampled)
        pairs = kinds.filter("kind = 'samples'").select("machine_id", F.col("day").alias(DAY))
        containing = _cycles_over(staged, after, sampled).join(pairs, KEYS, "left_semi")
        starts |= set(_days(containing.select(_day_of("cycle_start_ts").alias("day"))))
    if starts:
        _write_summary(staged, after, sorted(starts))
    _write_hourly(staged, after, sampled, sorted({*sampled, *by_kind["states"], *starts}))


def _write_summary(staged: store.Publication, after: DataFrame, starts: Sequence[str]) -> None:
    begun = cut_lineage(_begun(staged, after, starts), "begun_cycles")
    run = begun.select(F.explode(F.sequence(_day_of("cycle_start_ts"), _day_of("cycle_end_ts"))).alias("day"))
    used = staged.read("cycle_day_energy", _days(run)).groupBy("cycle_id").agg(F.sum("energy_kwh").alias("used"))
    energy = F.coalesce("used", F.lit(0)).cast("decimal(12,6)")
    summary = begun.join(used, "cycle_id", "left").withColumn("cycle_energy_kwh", energy)
    staged.write_days("cycle_energy_summary", summary.select(*schemas.CYCLE_ENERGY_SUMMARY.names), starts)


def _write_hourly(staged: store.Publication, after: DataFrame, sampled: Sequence[str], days: Sequence[str]) -> None:
    """The four hourly tables: energy where samples changed, everything else on all reached days."""
    table = "state_energy_summary_hourly"
    if sampled:
        cube = cut_lineage(kpi.energy_cube(staged.read("energy_enriched", sampled)), "energy_cube")
        staged.write_days(table, kpi.state_energy_summary_hourly(cube), sampled)
        staged.write_days("detailed_state_energy_summary_hourly", kpi.detailed_from_cube(cube), sampled)
    summary = staged.read("cycle_energy_summary", days)
    begun = _begun(staged, after, days)
    energy = summary.select("cycle_id", "cycle_energy_kwh")
    stats = kpi.cycle_stats_of(begun.join(energy, "cycle_id", "left"), staged.read("operation"))
    hourly = [
        cut_lineage(df, "hourly") for df in (staged.read(table, days), _state_time(staged, after, days), stats)
    ]
    staged.write_days("oee_energy_summary_hourly", kpi.oee_energy_summary_hourly(*hourly), days)
    staged.write_days("regression_base_hourly", kpi.regression_base_hourly(*hourly), days)
    if sinks.MOMENTS in staged.base.tables:
        staged.write_days(sinks.MOMENTS, sinks.moments_of(staged.read("regression_base_hourly", days)), days)
