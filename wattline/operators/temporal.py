"""Aligning time series: previous row, as-of join, interval join, interval split.

No operator here puts a whole key into one task. Rows are partitioned by
(key, block of time), normally the day, so a machine that holds a third of the
data is spread over its days. What must cross a block border (the last
counter, the last state, the running end of earlier intervals) is first reduced
to one row per (key, block) and carried over that table, which is small as long as
a block holds many rows: series of a row an hour are not reduced by hours at all.

The block is an argument with the day as default. Whoever knows that single
days of a key are too large for a task passes "hour", "minute" or "second"; the
results are the same. Minutes and seconds are carried in two steps, within the hour and over
the hours, so no window ever sees more than the blocks of an hour, or the hours or days of a key.

A key of NULL equals no other: such points keep their row and find nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.timeline import micros, unit_start
from wattline.session import cut_lineage

BLOCK = "bucket_start"
#: The day that aligned rows are partitioned by, beside their hour in `bucket_start`.
DAY_BLOCK = "_block_start"
_HOUR = "_hour_start"
_RANK = "_rank"
_CARRY, _LOOKUP, _POINT = 0, 1, 2
#: Overlapping intervals are covered by aligned slots of 16 ** level seconds; the last level spans millennia.
_LEVELS, _BITS = 10, 4
#: For a join they are covered by slots of 4 ** level seconds, all of one level that their length names.
_JOIN_BITS = 2


@dataclass(frozen=True)
class Lookup:
    """A series to look up: the latest row at or before a point supplies `cols` as struct `name`."""

    name: str
    df: DataFrame = field(repr=False)
    ts: str
    cols: Sequence[str]


def with_block(df: DataFrame, ts: str, block: str = "hour") -> DataFrame:
    """Add the start of the hour (or finer block) of `ts` as the partitioning column."""
    return df.withColumn(BLOCK, unit_start(df, ts, block))


def _over_earlier(
    blocks: DataFrame, by: Sequence[str], names: Sequence[str], block: str, backward: bool = False, largest: bool = False
) -> DataFrame:
    """Replace each column by its last (or largest) filled value in earlier blocks of the key.

    `backward` takes later blocks instead. Blocks of the same start tie and are left out.
    """

    def order(column: str) -> Column:
        return -micros(column) if backward else micros(column)

    def before(keys: Sequence[str], column: str):
        return Window.partitionBy(*keys).orderBy(order(column)).rangeBetween(Window.unboundedPreceding, -1)

    def pick(name: str, window) -> Column:
        return (F.max(name) if largest else F.last(name, ignorenulls=True)).over(window)

    if block in ("day", "hour"):
        return blocks.withColumns({n: pick(n, before(by, BLOCK)) for n in names})
    keys = [*by, _HOUR]
    timed = blocks.withColumn(_HOUR, unit_start(blocks, BLOCK, "hour"))
    filled = {n: F.when(F.col(n).isNotNull(), order(BLOCK)) for n in names}
    hours = timed.groupBy(*keys).agg(
        *[(F.max(n) if largest else F.max_by(n, filled[n])).alias(n) for n in names]
    )
    hours = hours.select(*keys, *[pick(n, before(by, _HOUR)).alias(f"_h{n}") for n in names])
    inside = timed.withColumns({n: pick(n, before(keys, BLOCK)) for n in names})
    # Within the hour later rows win; a running maximum is never below the one of earlier hours' blocks.
    merged = {n: (F.greatest(n, f"_h{n}") if largest else F.coalesce(n, f"_h{n}")) for n in names}
    return inside.join(hours, keys, "left").withColumns(merged).drop(_HOUR, *[f"_h{n}" for n in names])


def _tails(df: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str], name: str) -> DataFrame:
    """The last row of each (key, block) as struct `name`; at equal times the largest struct."""
    if len(cols) == 1:
        # A flat buffer keeps numeric columns in hash aggregation; one column cannot mix rows.
        last = df.groupBy(*by, BLOCK).agg(F.max_by(cols[0], F.struct(ts, cols[0])).alias(cols[0]))
        return last.select(*by, BLOCK, F.struct(*cols).alias(name))
    last = df.groupBy(*by, BLOCK).agg(F.max(F.struct(F.col(ts).alias("_at"), *cols)).alias("_last"))
    return last.select(*by, BLOCK, F.struct(*[F.col(f"_last.{c}").alias(c) for c in cols]).alias(name))


def _with_keys(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(by))


def latest_values(
    points: DataFrame,
    by: Sequence[str],
    ts: str,
    lookups: Sequence[Lookup] = (),
    previous: tuple[str, Sequence[str]] | None = None,
    block: str = "day",
) -> DataFrame:
    """Add to each point the latest row of every lookup and of the points before it.

    `lookups` are inclusive (a lookup row at the same time counts, the largest of
    several); `previous` names a struct taken from the point just before. A struct is NULL when
    there is no such row and not NULL when the row exists with NULL values.
    All series are sorted together once: one shuffle of the points on
    (key, block), whatever the number of lookups. The result keeps the block as
    `bucket_start` and that partitioning.
    """
    by = list(by)
    names = [lookup.name for lookup in lookups] + ([previous[0]] if previous else [])
    point_columns = [c for c in points.columns if c != BLOCK]
    points = with_block(points, ts, block)

    series = [with_block(_with_keys(lookup.df, by), lookup.ts, block) for lookup in lookups]
    tails = [_tails(df, by, lk.ts, lk.cols, lk.name) for df, lk in zip(series, lookups)]
    if previous:
        name, cols = previous
        occupied = _tails(points, by, ts, cols, name).withColumn("_has_points", F.lit(True))
    else:
        occupied = points.select(*by, BLOCK).distinct().withColumn("_has_points", F.lit(True))
    for tail in tails:
        occupied = occupied.unionByName(tail, allowMissingColumns=True)

    any_value = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names])
    carried = (
        _over_earlier(occupied, by, names, block)
        .filter(F.col("_has_points") & any_value)
        .drop("_has_points")
        .withColumn(_RANK, F.lit(_CARRY))
    )

    rows = points.withColumn(_RANK, F.lit(_POINT))
    if previous:
        rows = rows.withColumn(previous[0], F.struct(*previous[1]))
    rows = rows.unionByName(carried, allowMissingColumns=True)
    for df, lk in zip(series, lookups):
        rows = rows.unionByName(
            df.select(
                *by,
                BLOCK,
                F.col(lk.ts).alias(ts),
                F.struct(*lk.cols).alias(lk.name),
                F.lit(_LOOKUP).alias(_RANK),
            ),
            allowMissingColumns=True,
        )

    # Carried rows have no time and sort first; a lookup precedes a point at the same time.
    ties = [lookup.name for lookup in lookups]
    order = Window.partitionBy(*by, BLOCK).orderBy(F.col(ts).asc_nulls_first(), _RANK, *ties)
    up_to_now = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up_to_previous = order.rowsBetween(Window.unboundedPreceding, -1)
    values = {lk.name: F.last(lk.name, ignorenulls=True).over(up_to_now) for lk in lookups}
    if previous:
        values[previous[0]] = F.last(previous[0], ignorenulls=True).over(up_to_previous)
    return (
        rows.withColumns(values)
        .filter(F.col(_RANK) == _POINT)
        .select(*point_columns, BLOCK, *names)
    )


def previous_row(
    df: DataFrame, by: Sequence[str], ts: str, cols: dict[str, str], block: str = "day"
) -> DataFrame:
    """LAG by one row per key: `cols` maps a column to the name of its previous value."""
    out = latest_values(df, by, ts, previous=("_prev", list(cols)), block=block)
    return out.withColumns({new: F.col(f"_prev.{old}") for old, new in cols.items()}).drop("_prev")


def counter_delta(previous: Column, counter: Column, rate: Column, interval: Column) -> Column:
    """Growth of a cumulative counter, or rate x interval when it is missing or was reset.

    Product first, then the division by 3600: the other order loses digits in
    decimal arithmetic.
    """
    from_rate = (rate * interval / F.lit(3600)).cast("decimal(12,6)")
    return (
        F.when(counter >= previous, (counter - previous).cast("decimal(12,6)"))
        .when((interval > 0) & rate.isNotNull(), from_rate)
        .otherwise(F.lit(None).cast("decimal(12,6)"))
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    cols: Sequence[str],
    block: str = "day",
) -> DataFrame:
    """Left join to the latest right row with `right_ts <= left_ts` per key."""
    out = latest_values(left, by, left_ts, [Lookup("_match", right, right_ts, cols)], block=block)
    return out.withColumns({c: F.col(f"_match.{c}") for c in cols}).drop("_match")


def with_neighbours(
    intervals: DataFrame, by: Sequence[str], start: str, end: str, block: str = "day", ties: Sequence[str] = ()
) -> DataFrame:
    """Add `_prev_end` (largest end of all earlier intervals) and `_next_start` per key.

    Intervals are in order of start, end and the columns `ties`; NULL keys are left out.
    """
    by, intervals = list(by), _with_keys(intervals, by)
    blocked = with_block(intervals, start, block)
    edges = blocked.groupBy(*by, BLOCK).agg(
        F.min(start).alias("_following_start"), F.max(end).alias("_carried_end")
    )
    edges = _over_earlier(edges, by, ["_carried_end"], block, largest=True)
    edges = _over_earlier(edges, by, ["_following_start"], block, backward=True)
    inside = Window.partitionBy(*by, BLOCK).orderBy(start, end, *ties)
    return (
        blocked.withColumns(
            {
                "_prev_end": F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
                "_next_start": F.lead(start).over(inside),
            }
        )
        .join(edges, [*by, BLOCK], "left")
        .withColumns(
            {
                "_prev_end": F.greatest("_prev_end", "_carried_end"),
                "_next_start": F.coalesce("_next_start", "_following_start"),
            }
        )
        .drop("_carried_end", "_following_start")
    )


def _overlapping(marked: DataFrame, start: str, end: str) -> DataFrame:
    return marked.filter((F.col(start) < F.col("_prev_end")) | (F.col("_next_start") < F.col(end)))


def overlapping_intervals(
    intervals: DataFrame, by: Sequence[str], start: str, end: str, block: str = "day"
) -> DataFrame:
    """The non-empty intervals that overlap another one of their key."""
    marked = with_neighbours(intervals.filter(F.col(end) > F.col(start)), by, start, end, block)
    return _overlapping(marked, start, end).drop("_prev_end", "_next_start", BLOCK)


def blocks_touched(df: DataFrame, start: str, end: str, block: str = "hour") -> Column:
    """Starts of all hours (or finer blocks) that `[start, end)` touches; an end on a border opens no new one."""
    kind = df.schema[start].dataType
    last = F.date_trunc(block, F.col(end) - F.expr("INTERVAL 1 MICROSECOND")).cast(kind)
    return F.sequence(unit_start(df, start, block), last, F.expr(f"INTERVAL 1 {block}"))


def prepare_intervals(
    intervals: DataFrame, by: Sequence[str], start: str, end: str, cols: Sequence[str], block: str = "day"
) -> DataFrame:
    """The non-empty intervals with their neighbours, written once: lookup and overlaps read them from there."""
    plain = intervals.select(*by, start, end, *cols).filter(F.col(end) > F.col(start))
    return cut_lineage(with_neighbours(plain, by, start, end, block, cols), "intervals")


def interval_lookup(name: str, prepared: DataFrame, start: str, end: str, cols: Sequence[str]) -> Lookup:
    """Look up the interval that started last, with the largest end of the ones before it."""
    return Lookup(name, prepared.drop(BLOCK), start, [end, *cols, "_prev_end"])


def _seconds(ts: str) -> Column:
    """Whole seconds, rounded down."""
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def slots_covered(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """One row (`_level`, `_slot`) for each aligned slot of a cover of `[start, end)`.

    Level k has slots of 16 ** k seconds. The middle of an interval is covered by the
    largest slots that fit, its ends by smaller ones: at most 30 of each size, so that
    some 300 rows cover any length. Slots reach over the ends by less than a second.
    """
    low, over = _seconds(start), F.pmod(micros(end), F.lit(1_000_000)) > 0
    timed = intervals.withColumns(
        {
            "_low": low,
            "_high": _seconds(end) + over.cast("long"),
            "_level": F.explode(F.sequence(F.lit(0), F.lit(_LEVELS - 1))),
        }
    )

    bounds = timed.withColumns(
        {
            "_from": F.expr(f"shiftright(_low + shiftleft(1L, {_BITS} * _level) - 1, {_BITS} * _level)"),
            "_to": F.expr(f"shiftright(_high, {_BITS} * _level)"),
            "_up_from": F.expr(f"shiftright(_low + shiftleft(1L, {_BITS} * (_level + 1)) - 1, {_BITS} * (_level + 1))"),
            "_up_to": F.expr(f"shiftright(_high, {_BITS} * (_level + 1))"),
        }
    ).filter("_from < _to")
    runs = F.when(
        (F.col("_level") == _LEVELS - 1) | (F.col("_up_from") >= F.col("_up_to")),
        F.sequence("_from", F.col("_to") - 1),
    ).otherwise(
        F.concat(
            *[
                F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<long>"))
                for a, b in (
                    (F.col("_from"), F.shiftleft("_up_from", _BITS)),
                    (F.shiftleft("_up_to", _BITS), F.col("_to")),
                )
            ]
        )
    )
    return bounds.withColumn("_slot", F.explode(runs)).drop("_low", "_high", "_from", "_to", "_up_from", "_up_to")


def slots_touched(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """One row (`_level`, `_slot`) for each aligned slot that `[start, end)` touches, five at most.

    The level is the one whose slots of 4 ** level seconds are no longer than the interval, but longer
    than a quarter of it. Slots reach over the ends by less than the interval's length: who meets
    points there compares the times too.
    """
    over = F.pmod(micros(end), F.lit(1_000_000)) > 0
    timed = intervals.withColumns({"_low": _seconds(start), "_high": _seconds(end) + over.cast("long")})
    leveled = timed.withColumn("_level", F.expr(f"(length(bin(_high - _low)) - 1) div {_JOIN_BITS}").cast("int"))
    slots = F.expr(f"sequence(shiftright(_low, {_JOIN_BITS} * _level), shiftright(_high - 1, {_JOIN_BITS} * _level))")
    return leveled.withColumn("_slot", F.explode(slots)).drop("_low", "_high")


def finish_interval_join(
    aligned: DataFrame,
    name: str,
    prepared: DataFrame,
    by: Sequence[str],
    ts: str,
    start: str,
    end: str,
    cols: Sequence[str],
) -> DataFrame:
    """Turn the interval that started last into all intervals that contain the point.

    A point beyond the end of all earlier intervals lies in the last one or in
    none. The other points lie in intervals that overlap; these are dealt to the
    few slots they touch (`slots_touched`) and met by equality on (key, level, slot)
    at each level that some interval has. The slots are a written table: without
    overlaps it is empty and broadcast by its size, and no point is shuffled again.
    """
    rest = _overlapping(prepared, start, end).select(*by, start, end, *cols)
    pieces = slots_touched(rest, start, end).select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_level").alias("_piece_level"),
        F.col("_slot").alias("_piece_slot"),
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        *[F.col(c).alias(f"_{c}") for c in cols],
    )
    pieces = cut_lineage(pieces, "interval_slots")
    contested = F.coalesce(F.col(ts) < F.col(f"{name}._prev_end"), F.lit(False))
    # At most nineteen numbers, however many intervals there are.
    used = sorted(row[0] for row in pieces.select("_piece_level").distinct().collect())
    levels = F.array(
        *[
            F.struct(F.lit(at).alias("level"), F.shiftright(_seconds(ts), _JOIN_BITS * at).alias("slot"))
            for at in used or [0]
        ]
    )
    # Points that need no slot are spread by their block, in case the join shuffles.
    alone = F.array(F.struct(F.lit(-1).alias("level"), micros(BLOCK).alias("slot")))
    probes = aligned.withColumn("_probe", F.explode(F.when(contested, levels).otherwise(alone)))
    same = (F.col("_probe.level") == F.col("_piece_level")) & (F.col("_probe.slot") == F.col("_piece_slot"))
    for key in by:
        same = same & (F.col(key) == F.col(f"_{key}"))
    inside = (F.col(ts) >= F.col("_start")) & (F.col(ts) < F.col("_end"))
    met = probes.join(pieces, same, "left").filter((F.col("_probe.level") < 0) | inside)
    running = F.col(ts) < F.col(f"{name}.{end}")
    kept = [c for c in aligned.columns if c != name]
    return met.select(
        *kept,
        *[
            F.when(F.col("_probe.level") < 0, F.when(running, F.col(f"{name}.{c}"))).otherwise(F.col(f"_{c}")).alias(c)
            for c in cols
        ],
    )


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    by: Sequence[str],
    ts: str,
    start: str,
    end: str,
    cols: Sequence[str],
    block: str = "day",
) -> DataFrame:
    """Left join of points to all intervals `[start, end)` of their key that contain them."""
    prepared = prepare_intervals(intervals, by, start, end, cols, block)
    lookup = interval_lookup("_interval", prepared, start, end, cols)
    aligned = latest_values(points, by, ts, [lookup], block=block)
    return finish_interval_join(aligned, "_interval", prepared, by, ts, start, end, cols)


def to_intervals(
    events: DataFrame,
    by: Sequence[str],
    ts: str,
    end: str,
    bounds: DataFrame | None = None,
    bound: str | None = None,
    block: str = "day",
) -> DataFrame:
    """Turn events into intervals that last until the next event of the key.

    `end` is the time of the next event; the last one ends at the key's
    `bound` (NULL without bounds). With bounds, keys missing there are dropped.
    """
    by = list(by)
    blocked = with_block(events, ts, block)
    heads = blocked.groupBy(*by, BLOCK).agg(F.min(ts).alias("_following"))
    heads = _over_earlier(heads, by, ["_following"], block, backward=True)
    if bounds is not None:
        heads = heads.join(bounds.select(*by, F.col(bound).alias("_bound")), by).select(
            *by, BLOCK, F.coalesce("_following", "_bound").alias("_following")
        )
    inside = Window.partitionBy(*by, BLOCK).orderBy(ts)
    return (
        blocked.withColumn(end, F.lead(ts).over(inside))
        .join(heads, [*by, BLOCK], "inner")
        .withColumn(end, F.coalesce(end, "_following"))
        .drop("_following", BLOCK)
    )


def split_by_hour(
    intervals: DataFrame, start: str, end: str, piece_start: str = "interval_start", piece_end: str = "interval_end"
) -> DataFrame:
    """Cut `[start, end)` at hour borders; one row per touched hour with the clipped piece."""
    positive = intervals.filter(F.col(end) > F.col(start))
    return (
        positive.withColumn(BLOCK, F.explode(blocks_touched(positive, start, end)))
        .withColumns(
            {
                piece_start: F.greatest(start, BLOCK),
                piece_end: F.least(F.col(end), F.col(BLOCK) + F.expr("INTERVAL 1 HOUR")),
            }
        )
        .drop(start, end)
    )
