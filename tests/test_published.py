"""Publications as one commit, keyed merges, counts at the write, and refreshes that equal a rebuild."""

from __future__ import annotations

import os
import random
import subprocess
import sys
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import quality
from wattline.plans import enrich, incremental
from wattline.session import scratch_path
from wattline.sources import sinks, store
from wattline.streaming import published

HOURLY = list(schemas.HOURLY_TABLES)
RESULTS = [*incremental.SERIES, *schemas.DERIVED_TABLES, *HOURLY]


class Killed(BaseException):
    """Stands for a process that dies: nothing may depend on handlers that run after it."""


# -- commits -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def derived_dir(spark, plant):
    """A folder with published base and derived tables of the plant."""
    out_dir = scratch_path(spark, "plant")
    sinks.full_refresh(spark, plant.tables, out_dir, quality.primary_keys)
    sinks.rebuild_enriched(spark, plant.tables, out_dir)
    return out_dir


def test_readers_never_see_one_derived_table_without_the_other(spark, plant, derived_dir):
    out_dir = derived_dir
    seen, stop = [], threading.Event()

    def look():
        while not stop.is_set():
            held = store.snapshot(spark, out_dir)
            seen.append((held.number, held.rows("energy_enriched"), held.rows("cycle_energy_summary")))
            # The files of a snapshot stay, also when newer ones are published meanwhile.
            assert held.read("cycle_energy_summary").count() == held.rows("cycle_energy_summary")

    reader = threading.Thread(target=look)
    reader.start()
    half = {**plant.tables, "energy_measurement": plant.samples.filter("ts < '2024-01-15'"), "cycle_event": plant.cycles.limit(7)}
    sinks.rebuild_enriched(spark, half, out_dir)
    stop.set()
    reader.join()
    whole = (plant.samples.count(), plant.cycles.count())
    part = (plant.samples.filter("ts < '2024-01-15'").count(), 7)
    assert {rows[1:] for rows in seen} <= {whole, part} and seen[0][1:] == whole
    last = store.snapshot(spark, out_dir)
    assert (last.rows("energy_enriched"), last.rows("cycle_energy_summary")) == part
    # Older versions can still be read.
    assert store.snapshot(spark, out_dir, last.number - 1).read("energy_enriched").count() == whole[0]
    sinks.rebuild_enriched(spark, plant.tables, out_dir)


@pytest.mark.parametrize("step", ["first table", "between", "second table", "claim", "pointer"])
def test_a_rebuild_killed_anywhere_leaves_the_old_tables(spark, plant, monkeypatch, step, derived_dir):
    out_dir = derived_dir
    before = store.snapshot(spark, out_dir)
    monkeypatch.setattr(store.Publication, "discard", lambda self: None)

    def dies(*_, **__):
        raise Killed

    if step == "between":
        monkeypatch.setattr(enrich, "cycle_energy_summary", dies)
    elif step == "claim":
        monkeypatch.setattr(store, "_create", dies)
    elif step == "pointer":
        monkeypatch.setattr(store, "_write_text", dies)
    else:
        real, tables = store.Publication._stage, []

        def stage(self, table, df):
            tables.append(table)
            staged = real(self, table, df)
            if len(tables) == (1 if step == "first table" else 2):
                raise Killed
            return staged

        monkeypatch.setattr(store.Publication, "_stage", stage)
    with pytest.raises(Killed):
        sinks.rebuild_enriched(spark, {**plant.tables, "cycle_event": plant.cycles.limit(3)}, out_dir)
    monkeypatch.undo()
    after = store.snapshot(spark, out_dir)
    assert after.number == before.number and after.tables == before.tables
    assert after.read("cycle_energy_summary").count() == plant.cycles.count()
    if step == "pointer":
        # The number is claimed by what looks like a living publication, until the claim is old.
        with pytest.raises(store.PublicationConflict):
            sinks.rebuild_enriched(spark, plant.tables, out_dir)
        monkeypatch.setattr(store, "CLAIM_SECONDS", 0)
    sinks.rebuild_enriched(spark, plant.tables, out_dir)
    assert store.snapshot(spark, out_dir).number == before.number + 1


def rows_of(spark, pairs):
    """Dashboard rows (scope, headline)."""
    names = schemas.DASHBOARD_SUMMARY.names
    texts = {"target_name": "t", "target_label": "l", "model_type": "m", "significant_features": "", "explanation": "", "technical_note": ""}
    rows = [(scope, at, headline) for at, (scope, headline) in enumerate(pairs)]
    frame = spark.createDataFrame(rows, "model_scope string, display_order smallint, headline string")
    frame = frame.withColumns({c: F.lit(v) for c, v in texts.items()}).withColumns(
        {"n_obs": F.lit(1), "pseudo_r2": F.lit(0.5), "non_significant_features": F.lit(None).cast("string"), "sensitivity_message": F.lit("")}
    )
    return frame.select(*[c for c in names if c != "updated_at"])


def headlines(df):
    return {r.model_scope: r.headline for r in df.collect()}


def test_merges_rewrite_only_files_with_a_key(spark):
    out_dir = scratch_path(spark, "dashboard")
    sinks.create_dashboard(spark, out_dir)
    sinks.create_dashboard(spark, out_dir)
    assert store.snapshot(spark, out_dir).number == 1
    for scope in ("a", "b", "c"):
        sinks.upsert_dashboard(spark, out_dir, rows_of(spark, [(scope, "old")]))
    before = store.snapshot(spark, out_dir)
    table = "regression_dashboard_summary"
    files = set(before.read(table).inputFiles())
    got = sinks.upsert_dashboard(spark, out_dir, rows_of(spark, [("b", "new"), ("d", "new")]))
    assert headlines(got) == {"a": "old", "b": "new", "c": "old", "d": "new"}
    after = store.snapshot(spark, out_dir)
    kept = set(after.read(table).inputFiles()) & files
    untouched = before.read(table).filter("model_scope IN ('a', 'c')").select(F.input_file_name().alias("f")).distinct()
    assert {r.f for r in untouched.collect()} <= kept
    touched = {r.f for r in before.read(table).filter("model_scope = 'b'").select(F.input_file_name().alias("f")).collect()}
    assert not touched & kept and after.rows(table) == 4 and headlines(before.read(table)) == {"a": "old", "b": "old", "c": "old"}
    with pytest.raises(ValueError, match="repeat a key"):
        sinks.upsert_dashboard(spark, out_dir, rows_of(spark, [("a", "x"), ("a", "y")]))
    assert store.snapshot(spark, out_dir).number == after.number


def test_of_two_writers_one_gets_an_error(spark):
    out_dir = scratch_path(spark, "dashboard")
    sinks.create_dashboard(spark, out_dir)
    table = "regression_dashboard_summary"
    one, two = store.Publication(spark, out_dir), store.Publication(spark, out_dir)
    stamp = F.current_timestamp()
    one.merge(table, rows_of(spark, [("a", "one")]).withColumn("updated_at", stamp), ["model_scope"])
    two.merge(table, rows_of(spark, [("a", "two")]).withColumn("updated_at", stamp), ["model_scope"])
    two.commit()
    with pytest.raises(store.PublicationConflict):
        one.commit()
    one.discard()
    assert headlines(store.read_table(spark, out_dir, table)) == {"a": "two"}
    # The same when both find the number free and only one can claim it.
    claims = []

    def claim():
        try:
            store._create(spark, f"{out_dir}/_claim-x")
            claims.append(True)
        except FileExistsError:
            claims.append(False)

    threads = [threading.Thread(target=claim) for _ in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(claims) == [False] * 7 + [True]


def test_vacuum_deletes_what_is_old_and_superseded(spark, plant):
    out_dir = scratch_path(spark, "plant")
    sinks.full_refresh(spark, plant.tables, out_dir)
    first = store.snapshot(spark, out_dir)
    sinks.full_refresh(spark, {**plant.tables, "machine": plant.machine.limit(2)}, out_dir)
    sinks.full_refresh(spark, {**plant.tables, "machine": plant.machine.limit(1)}, out_dir)
    # Everything is young, then only the last two versions count.
    assert store.vacuum(spark, out_dir) == 0
    assert first.read("machine").count() == plant.machine.count()
    assert store.vacuum(spark, out_dir, seconds=-5) == len(schemas.BASE_TABLES)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        first.read("machine").count()
    last = store.snapshot(spark, out_dir)
    assert last.read("machine").count() == 1
    assert store.snapshot(spark, out_dir, last.number - 1).read("machine").count() == 2
    store.vacuum(spark, out_dir, keep=1, seconds=-5)
    assert store.snapshot(spark, out_dir).read("cycle_event").count() == plant.cycles.count()
    left = {table: os.listdir(f"{out_dir}/versions/{table}") for table in os.listdir(f"{out_dir}/versions")}
    assert all(len([v for v in versions if v.startswith("v=")]) == 1 for versions in left.values())


def test_single_days_are_replaced_and_vacuumed(spark):
    out_dir = scratch_path(spark, "days")
    table = "cycle_day_energy"

    def rows(days):
        frame = spark.createDataFrame([(day, f"c{n}") for day, n in days], "day string, cycle_id string")
        return frame.select(F.to_date("day").alias("day"), "cycle_id", F.lit(1).cast("decimal(22,6)").alias("energy_kwh"))

    store.publish(spark, {table: rows([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)])}, out_dir)
    with store.publication(spark, out_dir) as staged:
        staged.write_days(table, rows([("2024-01-02", 4), ("2024-01-03", 5)]), ["2024-01-02", "2024-01-03", "2024-01-04"])
    held = store.snapshot(spark, out_dir)
    assert held.days(table) == ["2024-01-01", "2024-01-02", "2024-01-03"] and held.rows(table) == 3
    assert sorted(r.cycle_id for r in held.read(table).collect()) == ["c1", "c4", "c5"]
    assert [r.cycle_id for r in held.read(table, ["2024-01-02"]).collect()] == ["c4"]
    store.vacuum(spark, out_dir, keep=1, seconds=-5)
    assert sorted(r.cycle_id for r in store.read_table(spark, out_dir, table).collect()) == ["c1", "c4", "c5"]
    with pytest.raises(ValueError, match="2024-01-09"):
        with store.publication(spark, out_dir) as staged:
            staged.write_days(table, rows([("2024-01-09", 6)]), ["2024-01-08"])
    with store.publication(spark, out_dir) as staged:
        staged.write_days(table, rows([]), ["2024-01-01"])
    assert store.snapshot(spark, out_dir).rows(table) == 2


def test_writes_count_their_rows_once(tmp_path):
    """In a session that repeats failed tasks: the first attempt of each task dies after its rows."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from wattline.session import build_session
from wattline.sources import store
spark = build_session("retries", "local[2,4]", spark__checkpoint__dir={str(tmp_path)!r})

def rows(batches):
    from pyspark import TaskContext
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")

df = spark.range(0, 1000, 1, 4).mapInArrow(rows, "id long")
print("rows", store.counted_write(df, lambda counted: counted.write.parquet({str(tmp_path / "out")!r})))
print("read", spark.read.parquet({str(tmp_path / "out")!r}).count())
print("none", store.counted_write(spark.createDataFrame([], "a int"), lambda counted: counted.write.parquet({str(tmp_path / "none")!r})))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "first attempt" in done.stderr
    assert done.stdout.split() == ["rows", "1000", "read", "1000", "none", "0"], done.stderr[-2000:]


# -- incremental refresh ---------------------------------------------------------------------------

START = datetime(2024, 3, 1)


def small_plant(spark, seed):
    """Series of a few machines with resets, gaps, late and long states, cycles over days and in parallel."""
    rng = random.Random(seed)
    samples, states, cycles = {}, {}, []
    for machine in ("A", "B", "C"):
        meter = 0.0
        # Machine C is silent in the middle: its last state and cycle go on for over ten days.
        days = [*range(2), *range(13, 15)] if machine == "C" else range(15)
        for day in days:
            for _ in range(rng.randint(2, 5)):
                ts = START + timedelta(days=day, seconds=rng.randrange(86_400))
                meter = 0.0 if rng.random() < 0.1 else meter + rng.random()
                samples[ts, machine] = (ts, machine, rng.random() * 9, None if rng.random() < 0.1 else meter, rng.choice([None, 60.0, 0.5]))
            for _ in range(rng.choice([0, 1, 2, 4])):
                ts = START + timedelta(days=day, seconds=rng.choice([0, 3600, rng.randrange(86_400)]))
                code, tag = rng.choice([("RUN", "termelő"), ("IDLE", "nem termelő"), ("FAILURE", "nem termelő és áll")])
                states[ts, machine] = (ts, machine, code, tag, None, rng.choice([None, True, False, False]), rng.choice([None, "simple_waiting"]))
            for _ in range(rng.choice([0, 1, 3])):
                begin = START + timedelta(days=day, seconds=rng.randrange(86_400))
                length = rng.choice([600, 7200, 86_400, 3 * 86_400, 86_400 - (begin - START).seconds])
                end = begin + timedelta(seconds=max(length, 1))
                cycles.append((f"{machine}{len(cycles)}", machine, rng.choice(["O1", "O2", "?"]), begin, end, 60.0, rng.choice(["good", "scrap"]), None))
    frames = {"energy_measurement": list(samples.values()), "machine_state_event": list(states.values()), "cycle_event": cycles}
    out = {}
    for table, rows in frames.items():
        schema = schemas.BASE_TABLES[table]
        text = ", ".join(f"{f.name} {'double' if 'decimal' in f.dataType.simpleString() else f.dataType.simpleString()}" for f in schema)
        out[table] = spark.createDataFrame(rows, text).select(*[F.col(f.name).cast(f.dataType) for f in schema])
    machines = [(m, m, None, None, None) for m in "ABCD"]
    out["machine"] = spark.createDataFrame(machines, schemas.MACHINE)
    out["operation"] = spark.createDataFrame([("O1", "x", 50.0), ("O2", "y", 70.0)], "operation_id string, operation_name string, i double").select(
        "operation_id", "operation_name", F.col("i").cast("decimal(10,2)").alias("ideal_cycle_time_sec")
    )
    out["state_mapping"] = spark.createDataFrame([], schemas.STATE_MAPPING)
    return out


def published_plant(spark, tables):
    out_dir = scratch_path(spark, "plant")
    sinks.full_refresh(spark, tables, out_dir, quality.primary_keys)
    stored = {t: store.read_table(spark, out_dir, t) for t in schemas.BASE_TABLES}
    sinks.rebuild_enriched(spark, stored, out_dir)
    sinks.publish_hourly(spark, {**stored, "energy_enriched": store.read_table(spark, out_dir, "energy_enriched")}, out_dir)
    incremental.publish_days(spark, out_dir)
    sinks.publish_moments(spark, out_dir)
    return out_dir


def contents(spark, out_dir):
    held = store.snapshot(spark, out_dir)
    found = {t: sorted(map(str, held.read(t).collect())) for t in RESULTS}
    assert {t: len(rows) for t, rows in found.items()} == {t: held.rows(t) for t in RESULTS}
    # Sums of doubles may differ in their last digits.
    found["moments"] = sorted(
        (r.target, r.machine_id, str(r.day), r.n, *[round(v, 6) + 0.0 for v in r.center], *[round(v, 6) + 0.0 for v in r.cross])
        for r in held.read(sinks.MOMENTS).collect()
    )
    return found


def test_refreshes_equal_the_rebuild(spark):
    """Two batches of rows of any age; runs over several seeds gave the same."""
    tables = small_plant(spark, 1)
    rng = random.Random(101)
    parts = {t: tables[t].collect() for t in incremental.SERIES}
    arrival = {t: [rng.choice([0, 0, 0, 1, 2]) for _ in rows] for t, rows in parts.items()}

    def upto(t, wanted):
        rows = [row for row, at in zip(parts[t], arrival[t], strict=True) if wanted(at)]
        return spark.createDataFrame(rows, tables[t].schema)

    out_dir = published_plant(spark, {**tables, **{t: upto(t, lambda at: at == 0) for t in parts}})
    for batch in (1, 2):
        incremental.refresh(spark, out_dir, {t: upto(t, lambda at, b=batch: at == b) for t in parts}, quality.primary_keys)
    wanted = contents(spark, published_plant(spark, tables))
    got = contents(spark, out_dir)
    for table in [*RESULTS, "moments"]:
        assert got[table] == wanted[table], table
    # The machine days carry on: what refreshes keep of them is what a rebuild would hold.
    fresh = incremental.machine_days(*[store.read_table(spark, out_dir, t) for t in incremental.SERIES])
    kept = store.read_table(spark, out_dir, "machine_day")

    def days(df):
        return sorted((str(r[:-1]), sorted(map(str, r.running))) for r in df.collect())

    assert days(kept) == days(fresh.select(*kept.columns))


@pytest.fixture(scope="module")
def refreshed(spark):
    """(tables, folder) of a small published plant."""
    tables = small_plant(spark, 5)
    return tables, published_plant(spark, tables)


def test_a_refresh_that_repeats_a_key_changes_nothing(spark, refreshed):
    tables, out_dir = refreshed
    before = store.snapshot(spark, out_dir)
    with pytest.raises(store.RefreshRejected):
        incremental.refresh(spark, out_dir, {"energy_measurement": tables["energy_measurement"].limit(1)}, quality.primary_keys)
    with pytest.raises(ValueError, match="operation"):
        incremental.refresh(spark, out_dir, {"operation": tables["operation"]})
    assert store.snapshot(spark, out_dir).tables == before.tables
    incremental.refresh(spark, out_dir, {t: tables[t].limit(0) for t in incremental.SERIES})
    assert store.snapshot(spark, out_dir).tables == before.tables
    bare = scratch_path(spark, "bare")
    sinks.full_refresh(spark, tables, bare)
    with pytest.raises(FileNotFoundError, match="publish_days"):
        incremental.refresh(spark, bare, {"cycle_event": tables["cycle_event"].limit(1)})


def test_a_refresh_reads_and_writes_the_reached_days_only(spark, monkeypatch, refreshed):
    tables, out_dir = refreshed
    before = store.snapshot(spark, out_dir)
    ts = datetime(2024, 3, 6, 23, 59, 59, 500_000)
    late = spark.createDataFrame([(ts, "A", 1.0, 1000.0, 60.0)], "ts timestamp_ntz, machine_id string, p double, c double, i double")
    late = late.select("ts", "machine_id", *[F.col(a).cast(schemas.ENERGY_MEASUREMENT[b].dataType).alias(b) for a, b in zip("pci", schemas.ENERGY_MEASUREMENT.names[2:], strict=True)])
    read, real = [], store.Snapshot._load

    def load(self, table, paths):
        paths = list(paths)
        read.extend((table, path.rsplit("date=", 1)[-1]) for path in paths if "date=" in path)
        return real(self, table, paths)

    monkeypatch.setattr(store.Snapshot, "_load", load)
    after = incremental.refresh(spark, out_dir, {"energy_measurement": late}, quality.primary_keys)
    monkeypatch.undo()
    assert {day for table, day in read if table == "energy_measurement"} <= {"2024-03-06", "2024-03-07"}
    # Cycles that contain the changed samples may have begun up to three days before.
    assert {day for table, day in read if table == "energy_enriched"} <= {"2024-03-06", "2024-03-07"}
    allowed = {f"2024-03-0{day}" for day in range(3, 10)}
    for table in ("machine_state_event", "cycle_event", *HOURLY):
        assert {day for name, day in read if name == table} <= allowed, table
    for table in RESULTS:
        old, new = before.paths(table), after.paths(table)
        assert {day for day in new if old.get(day) != new[day]} <= allowed
        assert len(set(old.values()) & set(new.values())) >= 8
    rebuilt = {**tables, "energy_measurement": tables["energy_measurement"].unionByName(late)}
    assert contents(spark, out_dir) == contents(spark, published_plant(spark, rebuilt))


def test_streams_keep_published_tables_up_to_date(spark, tmp_path):
    tables = small_plant(spark, 7)
    empty = {t: tables[t].limit(0) if t in incremental.SERIES else tables[t] for t in tables}
    out_dir = published_plant(spark, empty)
    checkpoint, arrived = str(tmp_path / "checkpoint"), {t: [] for t in incremental.SERIES}

    def arrive(number, condition):
        for t in incremental.SERIES:
            time = "cycle_start_ts" if t == "cycle_event" else "ts"
            rows = tables[t].filter(condition.format(ts=time))
            rows.write.parquet(f"{tmp_path}/{t}/{number}")
            arrived[t].append(rows)
        stream = published.series_stream(spark, {t: f"{tmp_path}/{t}/*" for t in incremental.SERIES})
        published.start_published(stream, out_dir, "s", checkpoint, quality.primary_keys).awaitTermination()

    def batch_result():
        so_far = {t: frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1]) for t, frames in arrived.items()}
        return contents(spark, published_plant(spark, {**tables, **so_far}))

    arrive(0, "day({ts}) <> 5 AND {ts} < '2024-03-12'")
    assert contents(spark, out_dir) == batch_result()
    # The batch was published, but the stream died before it noted so: it comes again after the restart.
    number = store.snapshot(spark, out_dir).number
    (done,) = [f"{checkpoint}/commits/{n}" for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()]
    os.remove(done)
    crc = f"{checkpoint}/commits/.{os.path.basename(done)}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    arrive(1, "day({ts}) = 5 OR {ts} >= '2024-03-12'")
    held = store.snapshot(spark, out_dir)
    assert held.number == number + 1 and held.notes == {"stream s": 1}
    assert contents(spark, out_dir) == batch_result()


def test_streamed_samples_equal_the_batch_within_the_watermark(spark, tmp_path):
    from wattline.streaming import enriched

    tables = small_plant(spark, 8)
    # Rows arrive up to a day and a half late, over three arrivals.
    for number in range(3):
        for t in incremental.SERIES:
            time = "cycle_start_ts" if t == "cycle_event" else "ts"
            late = F.least(F.floor((F.day(time) + F.pmod(F.xxhash64(*tables[t].columns), F.lit(2))) / 6), F.lit(2))
            tables[t].filter(late == number).write.parquet(f"{tmp_path}/{t}/{number}")
        stream = published.series_stream(spark, {t: f"{tmp_path}/{t}/*" for t in incremental.SERIES})
        query = enriched.energy_enriched(stream, "3 days").writeStream.outputMode("append").format("parquet")
        query = query.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
    last = max(tables["cycle_event"].agg(F.max("cycle_start_ts")).first()[0], *[tables[t].agg(F.max("ts")).first()[0] for t in incremental.SERIES[:2]])
    batch = enrich.energy_enriched(*[tables[t] for t in incremental.SERIES]).filter(F.col("ts") <= F.lit(last - timedelta(days=3)))
    got = spark.read.schema(schemas.ENERGY_ENRICHED).parquet(f"{tmp_path}/out")
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))
    assert 0 < got.count() < tables["energy_measurement"].count() * 2 and got.filter("cycle_id IS NOT NULL").count() > 5
