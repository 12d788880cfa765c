"""Time alignment against brute force on small random series."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from wattline.operators import quality, temporal
from wattline.session import cut_lineage

T0 = datetime(2026, 3, 1, 10, 0, 0)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def series(seed: int, n: int, hours: float, keys: int, hot: bool = True):
    """Random (key, time) pairs without repeats; the first key gets a third of them."""
    rng = random.Random(seed)
    seen = {}
    while len(seen) < n:
        key = "A" if hot and rng.random() < 0.33 else f"K{rng.randrange(keys)}"
        seen[(key, at(rng.randrange(int(hours * 60)) + rng.choice([0, 0, 0.5])))] = None
    return sorted(seen)


@pytest.mark.parametrize("seed,block", [(1, "hour"), (2, "minute"), (3, "second")])
def test_previous_row_does_not_skip_nulls(spark, seed, block):
    rng = random.Random(seed)
    rows = [(k, t, None if rng.random() < 0.2 else rng.randrange(100)) for k, t in series(seed, 150, 200, 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int")
    got = {(r.k, r.ts): r.before for r in temporal.previous_row(df, ["k"], "ts", {"v": "before"}, block).collect()}
    last = {}
    for k, t, v in rows:
        assert got[(k, t)] == last.get(k)
        last[k] = v
    assert len(got) == len(rows)


@pytest.mark.parametrize("seed,block", [(4, "hour"), (5, "minute"), (6, "second")])
def test_asof_join_is_inclusive_and_carries_over_blocks(spark, seed, block):
    points, events = series(seed, 150, 90, 4), series(seed + 100, 40, 90, 5)
    left = spark.createDataFrame(points, "k string, ts timestamp_ntz")
    right = spark.createDataFrame(
        [(k, t, None if i % 7 == 0 else f"s{i}") for i, (k, t) in enumerate(events)], "k string, at timestamp_ntz, s string"
    )
    got = {(r.k, r.ts): r.s for r in temporal.asof_join(left, right, ["k"], "ts", "at", ["s"], block).collect()}
    labels = {e: (None if i % 7 == 0 else f"s{i}") for i, e in enumerate(events)}
    assert len(got) == len(points)
    for k, t in points:
        before = [e for e in events if e[0] == k and e[1] <= t]
        assert got[(k, t)] == (labels[max(before)] if before else None)


def test_asof_ties_and_first_point(spark):
    left = spark.createDataFrame([("A", at(0)), ("A", at(5))], "k string, ts timestamp_ntz")
    right = spark.createDataFrame([("A", at(5), "x")], "k string, ts timestamp_ntz, s string")
    got = {r.ts: r.s for r in temporal.asof_join(left, right, ["k"], "ts", "ts", ["s"]).collect()}
    assert got == {at(0): None, at(5): "x"}


@pytest.mark.parametrize(
    "seed,longest,block", [(7, 20, "hour"), (8, 90, "minute"), (9, 400, "hour"), (10, 2000, "hour"), (11, 900, "minute")]
)
def test_interval_join_finds_all_overlapping_intervals(spark, seed, longest, block):
    rng = random.Random(seed)
    points = series(seed, 200, 72, 3)
    intervals = []
    for i, (k, t) in enumerate(series(seed + 50, 60, 72, 3)):
        intervals.append((k, t, t + timedelta(minutes=rng.choice([0, -3, 1, 5, rng.randrange(1, longest)])), f"c{i}"))
    left = spark.createDataFrame(points, "k string, ts timestamp_ntz")
    right = spark.createDataFrame(intervals, "k string, s timestamp_ntz, e timestamp_ntz, id string")
    joined = temporal.interval_join(left, right, ["k"], "ts", "s", "e", ["id"], block)
    got = sorted((r.k, r.ts, r.id or "") for r in joined.collect())
    wanted = []
    for k, t in points:
        inside = [i[3] for i in intervals if i[0] == k and i[1] <= t < i[2]]
        wanted += [(k, t, c) for c in inside] or [(k, t, "")]
    assert got == sorted(wanted)


def test_interval_join_half_open_border(spark):
    cycles = spark.createDataFrame(
        [("M", at(0), at(5), "100"), ("M", at(5), at(10), "101")],
        "m string, s timestamp_ntz, e timestamp_ntz, cycle_id string",
    )
    probes = [at(0), at(5) - timedelta(seconds=1), at(5), at(10) - timedelta(seconds=1), at(10)]
    points = spark.createDataFrame([("M", p) for p in probes], "m string, ts timestamp_ntz")
    got = {r.ts: r.cycle_id for r in temporal.interval_join(points, cycles, ["m"], "ts", "s", "e", ["cycle_id"]).collect()}
    assert [got[p] for p in probes] == ["100", "100", "101", "101", None]


@pytest.mark.parametrize("block", ["hour", "minute"])
def test_intervals_and_hour_pieces(spark, block):
    events = spark.createDataFrame(
        [("A", at(30), "x"), ("A", at(60), "y"), ("A", at(290), "z"), ("B", at(10), "x")],
        "k string, ts timestamp_ntz, s string",
    )
    bounds = spark.createDataFrame([("A", at(300)), ("B", at(10)), ("C", at(0))], "k string, until timestamp_ntz")
    intervals = temporal.to_intervals(events, ["k"], "ts", "end", bounds, "until", block)
    got = {(r.k, r.ts): r.end for r in intervals.collect()}
    # y begins on the hour, runs over several hours; B's only event ends at its own start.
    assert got == {("A", at(30)): at(60), ("A", at(60)): at(290), ("A", at(290)): at(300), ("B", at(10)): at(10)}

    pieces = temporal.split_by_hour(intervals, "ts", "end").collect()
    assert all(p.interval_start >= p.bucket_start for p in pieces)
    assert all(p.interval_end <= p.bucket_start + timedelta(hours=1) for p in pieces)
    lengths = {}
    for p in pieces:
        lengths[p.s] = lengths.get(p.s, timedelta()) + (p.interval_end - p.interval_start)
    assert lengths == {"x": timedelta(minutes=30), "y": timedelta(minutes=230), "z": timedelta(minutes=10)}
    assert sorted(p.bucket_start.hour for p in pieces if p.s == "x") == [10]
    assert sorted(p.bucket_start.hour for p in pieces if p.s == "y") == [11, 12, 13, 14]


def test_overlaps_are_found_across_hours(spark):
    cycles = spark.createDataFrame(
        [
            ("c1", "A", at(0), at(400)),
            ("c2", "A", at(10), at(20)),
            ("c3", "A", at(200), at(210)),
            ("c4", "A", at(400), at(410)),
            ("c5", "B", at(5), at(15)),
        ],
        "cycle_id string, machine_id string, cycle_start_ts timestamp_ntz, cycle_end_ts timestamp_ntz",
    )
    assert sorted(r.key for r in quality.overlapping_cycles(cycles).collect()) == ["c2", "c3"]
    both = temporal.overlapping_intervals(cycles, ["machine_id"], "cycle_start_ts", "cycle_end_ts")
    assert sorted(r.cycle_id for r in both.collect()) == ["c1", "c2", "c3"]


@pytest.mark.parametrize("end", [at(2 * 365 * 24 * 60), datetime(9999, 12, 31, 23, 59, 59, 999999)])
def test_long_intervals_are_few_slots(spark, end):
    rows = [("A", at(0) + timedelta(microseconds=7), end, "long"), ("A", at(5), at(6), "short")]
    intervals = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz, id string")
    slots = temporal.slots_covered(intervals, "s", "e").groupBy("id").count().collect()
    counts = {r.id: r["count"] for r in slots}
    assert counts["long"] < 1000 and counts["short"] <= 60
    points = [at(-1), at(0), at(0) + timedelta(microseconds=7), at(5), at(5.5), at(6), at(7), at(500_000), end - timedelta(microseconds=1)]
    if end.year < 9999:
        points += [end, end + timedelta(days=1)]
    frame = spark.createDataFrame([("A", t) for t in points], "k string, ts timestamp_ntz")
    joined = temporal.interval_join(frame, intervals, ["k"], "ts", "s", "e", ["id"]).collect()
    wanted = [(t, name) for t in points for name in [i[3] for i in rows if i[1] <= t < i[2]] or [None]]
    assert sorted(((r.ts, r.id) for r in joined), key=repr) == sorted(wanted, key=repr)


def test_slots_cover_intervals_once(spark):
    rng = random.Random(12)
    rows = []
    for i in range(300):
        start = datetime(1969, 12, 31) + timedelta(seconds=rng.randrange(10**5), microseconds=rng.choice([0, 1, 999_999]))
        rows.append((i, start, start + timedelta(seconds=rng.choice([1, 15, 16, 17, 300, 10**4, 10**7]) + rng.random())))
    frame = spark.createDataFrame(rows, "id int, s timestamp_ntz, e timestamp_ntz")
    parts = {}
    for r in temporal.slots_covered(frame, "s", "e").collect():
        parts.setdefault(r.id, []).append((r._slot * 16**r._level, (r._slot + 1) * 16**r._level))
    epoch = datetime(1970, 1, 1)
    for i, start, end in rows:
        pieces = sorted(parts[i])
        assert all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        low, high = (start - epoch).total_seconds(), (end - epoch).total_seconds()
        assert low - 1 < pieces[0][0] <= low and high <= pieces[-1][1] < high + 1


def test_joined_intervals_touch_few_slots(spark, monkeypatch):
    rng = random.Random(13)
    rows = []
    for i in range(400):
        start = datetime(1969, 12, 31) + timedelta(seconds=rng.randrange(10**5), microseconds=rng.choice([0, 1, 999_999]))
        rows.append(("A", start, start + timedelta(seconds=rng.choice([0.5, 1, 3, 16, 300, 9000, 10**7]) + rng.random() / 2), str(i)))
    frame = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz, id string")
    parts = {}
    for r in temporal.slots_touched(frame, "s", "e").collect():
        parts.setdefault(r.id, []).append((r._slot * 4**r._level, (r._slot + 1) * 4**r._level))
    epoch = datetime(1970, 1, 1)
    for _, start, end, i in rows:
        pieces = sorted(parts[i])
        low, high = (start - epoch).total_seconds(), (end - epoch).total_seconds()
        assert len(pieces) <= 5 and all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        assert pieces[0][0] <= low < pieces[0][1] and pieces[-1][0] < high <= pieces[-1][1]

    # The join writes no more of them, and still finds every interval and only those.
    written = {}

    def kept(df, name):
        written[name] = cut_lineage(df, name)
        return written[name]

    monkeypatch.setattr(temporal, "cut_lineage", kept)
    points = [datetime(1969, 12, 31) + timedelta(seconds=rng.randrange(10**5), microseconds=rng.randrange(10**6)) for _ in range(300)]
    times = spark.createDataFrame([("A", t) for t in points], "k string, ts timestamp_ntz")
    joined = temporal.interval_join(times, frame, ["k"], "ts", "s", "e", ["id"]).collect()
    wanted = [(t, i) for t in points for i in [r[3] for r in rows if r[1] <= t < r[2]] or [None]]
    assert sorted(((r.ts, r.id) for r in joined), key=repr) == sorted(wanted, key=repr)
    assert written["interval_slots"].count() <= 5 * len(rows)


def test_null_keys_match_nothing(spark):
    points = spark.createDataFrame([(None, at(5)), ("A", at(5))], "k string, ts timestamp_ntz")
    events = spark.createDataFrame([(None, at(1), "x", 1), ("A", at(2), "y", 2)], "k string, ts timestamp_ntz, s string, n int")
    got = {r.k: (r.s, r.n) for r in temporal.asof_join(points, events, ["k"], "ts", "ts", ["s", "n"]).collect()}
    assert got == {None: (None, None), "A": ("y", 2)}
    spans = spark.createDataFrame(
        [(None, at(0), at(9), "x"), (None, at(1), at(8), "x2"), ("A", at(0), at(9), "y"), ("A", at(1), at(8), "y2")],
        "k string, s timestamp_ntz, e timestamp_ntz, id string",
    )
    joined = temporal.interval_join(points, spans, ["k"], "ts", "s", "e", ["id"]).collect()
    assert sorted(((r.k, r.id) for r in joined), key=repr) == [("A", "y"), ("A", "y2"), (None, None)]


def test_equal_times_take_one_whole_row(spark):
    points = spark.createDataFrame([("A", at(5)), ("A", at(90))], "k string, ts timestamp_ntz")
    rows = [("A", at(5), "x", 9), ("A", at(5), "y", 1), ("A", at(5), None, 100)]
    events = spark.createDataFrame(rows, "k string, ts timestamp_ntz, s string, n int")
    got = {(r.s, r.n) for r in temporal.asof_join(points, events, ["k"], "ts", "ts", ["s", "n"]).collect()}
    assert got == {("y", 1)}


def test_repeated_intervals_all_match(spark):
    spans = spark.createDataFrame([("A", at(0), at(9), "x")] * 3 + [("A", at(0), at(9), "w")], "k string, s timestamp_ntz, e timestamp_ntz, id string")
    points = spark.createDataFrame([("A", at(0)), ("A", at(8)), ("A", at(9))], "k string, ts timestamp_ntz")
    joined = temporal.interval_join(points, spans, ["k"], "ts", "s", "e", ["id"]).collect()
    assert sorted(((r.ts, r.id) for r in joined), key=repr) == sorted([(at(m), i) for m in (0, 8) for i in "wxxx"] + [(at(9), None)], key=repr)


def test_enrichment_does_not_depend_on_the_block(plant):
    from wattline.plans import enrich

    inputs = plant.samples, plant.states, plant.cycles
    by_hour, by_minute = enrich.energy_enriched(*inputs), enrich.energy_enriched(*inputs, "minute")
    assert by_hour.exceptAll(by_minute).count() == 0 and by_minute.exceptAll(by_hour).count() == 0


def test_no_window_gathers_a_whole_key(plant):
    """Windows over rows are partitioned by key and hour; those by key alone run over block starts."""
    plan = plant.by_hour._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" +-:").startswith("Window ")]
    assert len(windows) >= 2
    for line in windows:
        partition, order = line.rsplit("], [", 2)[-2:]
        assert "bucket_start" in partition or ("ts#" not in order and order.startswith("_w"))


def test_hourly_sums_add_no_shuffle(plant):
    from wattline.plans import kpi

    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert shuffles(kpi.state_energy_summary_hourly(plant.by_hour)) <= shuffles(plant.by_hour)
    assert shuffles(kpi.energy_cube(plant.by_hour)) <= shuffles(plant.by_hour)


def test_sparse_series_are_carried_by_the_day(spark):
    """With a row or less an hour, hours would carry as many rows over the blocks as the series have."""
    from wattline.plans import enrich

    rng = random.Random(14)
    moments = sorted(rng.sample(range(10 * 24 * 60), 200))
    rows = [("M", T0 + timedelta(minutes=m), f"s{i}") for i, m in enumerate(moments) if i % 2]
    points = [("M", T0 + timedelta(minutes=m)) for i, m in enumerate(moments) if not i % 2]
    left = spark.createDataFrame(points, "k string, ts timestamp_ntz")
    right = spark.createDataFrame(rows, "k string, at timestamp_ntz, s string")
    want = {p[1]: max((r for r in rows if r[1] <= p[1]), default=(None, None, None), key=lambda r: r[1] or T0)[2] for p in points}
    for block in ("day", "hour"):
        got = temporal.asof_join(left, right, ["k"], "ts", "at", ["s"], block)
        assert {r.ts: r.s for r in got.collect()} == want
    samples = left.selectExpr("ts", "k AS machine_id", "0.5BD AS power_kw", "1BD AS energy_kwh_cumulative", "60BD AS sample_interval_sec")
    plan = enrich.delta_energy(samples)._jdf.queryExecution().optimizedPlan().toString()
    assert "date_trunc(day" in plan and "date_trunc(hour" not in plan
