"""CSV input, stored tables, upsert and streams."""

from __future__ import annotations

import os
import shutil
from datetime import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import queries, schemas
from wattline.operators import quality
from wattline.plans import kpi
from wattline.session import scratch_path
from wattline.sources import readers, seed_csv, sinks, store
from wattline.streaming import hourly


def parsed(spark, *words):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    return [r.b for r in df.select("i", seed_csv.parse_bool(F.col("w")).alias("b")).orderBy("i").collect()]


def test_parse_bool(spark):
    assert all(parsed(spark, "true", "True", "1", "yes", "y", " TRUE "))
    assert not any(parsed(spark, "false", "False", "0", "no", "n", None))
    with pytest.raises(PySparkException, match="Invalid boolean value: maybe"):
        parsed(spark, "maybe")


def write(directory, table, text):
    os.makedirs(directory, exist_ok=True)
    with open(f"{directory}/{table}.csv", "w", encoding="utf-8") as out:
        out.write(text)


def test_seed_table(spark, tmp_path):
    write(
        tmp_path,
        "machine_state_event",
        "idle_reason,ts,machine_id,detailed_state_code,state_tag,is_planned_stop,reason_code,extra\n"
        "NaN,2026-03-01 06:00:00+00:00,M1,RUN,termelő,,,1\n"
        "simple_waiting,2026-03-01 08:00:00+02:00,M2,IDLE,nem termelő,yes,n/a,2\n",
    )
    df = seed_csv.read_seed_table(spark, str(tmp_path), "machine_state_event")
    assert df.columns == schemas.MACHINE_STATE_EVENT.names
    first, second = df.orderBy("machine_id").collect()
    assert first.ts == second.ts and first.state_tag == "termelő"
    assert (first.is_planned_stop, second.is_planned_stop) == (False, True)
    assert (first.idle_reason, second.idle_reason, second.reason_code) == (None, "simple_waiting", None)


def test_seed_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        seed_csv.read_seed_table(spark, str(tmp_path), "operation")
    write(tmp_path, "operation", "operation_id,operation_name\nO1,x\n")
    with pytest.raises(PySparkException):
        seed_csv.read_seed_table(spark, str(tmp_path), "operation")
    write(tmp_path, "operation", "operation_id,operation_name,ideal_cycle_time_sec\nO1,x,fast\n")
    with pytest.raises(PySparkException):
        seed_csv.read_seed_table(spark, str(tmp_path), "operation").collect()
    with pytest.raises(FileNotFoundError):
        readers.scan_regression_csv(spark, f"{tmp_path}/none.csv")


def test_refresh_rejects_bad_tables_and_keeps_the_old_ones(spark, plant):
    out_dir = scratch_path(spark, "plant")
    sinks.full_refresh(spark, plant.tables, out_dir, quality.primary_keys)
    sinks.rebuild_enriched(spark, plant.tables, out_dir)
    assert store.read_table(spark, out_dir, "energy_enriched").count() == plant.samples.count()

    twice = {**plant.tables, "machine": plant.machine.unionByName(plant.machine)}
    with pytest.raises(sinks.RefreshRejected):
        sinks.full_refresh(spark, twice, out_dir, quality.primary_keys)
    assert store.read_table(spark, out_dir, "machine").count() == plant.machine.count()
    assert store.read_table(spark, out_dir, "energy_enriched").count() == plant.samples.count()

    stored = {**plant.tables, "energy_enriched": store.read_table(spark, out_dir, "energy_enriched")}
    sinks.publish_hourly(spark, stored, out_dir)
    hourly_tables = list(schemas.HOURLY_TABLES)
    assert all(store.read_table(spark, out_dir, t).count() > 0 for t in hourly_tables)
    sinks.full_refresh(spark, plant.tables, out_dir, quality.primary_keys)
    cleared = ["energy_enriched", "cycle_energy_summary", *hourly_tables]
    assert all(store.read_table(spark, out_dir, t).count() == 0 for t in cleared)
    # Superseded versions stay for their readers until they are vacuumed: then one folder per published table is left.
    store.vacuum(spark, out_dir, keep=1, seconds=-5)
    left = {t: os.listdir(f"{out_dir}/versions/{t}") for t in os.listdir(f"{out_dir}/versions")}
    assert sorted(t for t, versions in left.items() if any(v.startswith("v=") for v in versions)) == sorted(schemas.BASE_TABLES)


def test_range_reads_prune_days(spark, plant):
    path = scratch_path(spark, "hourly")
    sinks.write_by_date(plant.energy_hourly, path, "bucket_start")
    part = store.read_range(spark, path, "bucket_start", "2024-01-02 00:00:00", "2024-01-03 12:00:00")
    wanted = plant.energy_hourly.filter("bucket_start between '2024-01-02 00:00:00' and '2024-01-03 12:00:00'")
    assert part.count() == wanted.count() > 0
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(bucket_start" in plan


def test_broken_csv_rows_stop_the_load(spark, tmp_path):
    header = "operation_id,operation_name,ideal_cycle_time_sec\n"
    for name, row in {"surplus": "O1,x,5,9\n", "short": "O1,x\n"}.items():
        write(tmp_path / name, "operation", header + "O0,ok,1\n" + row)
        table = seed_csv.read_seed_table(spark, str(tmp_path / name), "operation")
        for rows in (table, table.select("operation_id")):
            with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED_CSV_RECORD"):
                rows.collect()
    write(tmp_path / "lines", "operation", header + 'O1,"first\nsecond, ""quoted""",5\n')
    (row,) = seed_csv.read_seed_table(spark, str(tmp_path / "lines"), "operation").collect()
    assert (row.operation_name, float(row.ideal_cycle_time_sec)) == ('first\nsecond, "quoted"', 5.0)


def test_all_white_space_around_booleans_is_stripped(spark):
    assert parsed(spark, "\tyes\n", "\u00a0no\u00a0") == [True, False]


@pytest.mark.parametrize("name", ["panel_oee_gauge", "panel_state_share", "panel_state_timeseries", "panel_category_timeseries", "panel_parts_vs_energy"])
def test_panels_read_published_days(spark, sf_dir, name):
    from wattline import queries

    plan = queries.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("date" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    assert "power_kw" not in plan.split("ReadSchema")[0]
    assert queries.LO > queries.derived.WINDOW[0] and queries.HI < queries.derived.WINDOW[1]


def test_all_published_hours_are_read_back(spark, sf_dir, plant):
    from wattline import queries

    whole = queries.queries()["publish_hourly_whole"](spark, sf_dir)
    got = {r.table_name: r["count"] for r in whole.groupBy("table_name").count().collect()}
    assert got == {
        "state_energy_summary_hourly": plant.energy_hourly.count(),
        "detailed_state_energy_summary_hourly": plant.detailed_hourly.count(),
        "oee_energy_summary_hourly": plant.oee.count(),
        "regression_base_hourly": plant.base.count(),
    }
    shown = queries.queries()["publish_hourly"](spark, sf_dir)
    assert shown.count() == whole.count()


def test_full_refresh_load_clears_published_hours(spark, sf_dir, monkeypatch):
    from wattline import queries

    before, refresh = [], sinks.full_refresh

    def watched(spark, frames, out_dir, *rest):
        tables = schemas.HOURLY_TABLES if store.current(spark, out_dir) else []
        before.append({t: store.read_table(spark, out_dir, t).count() for t in tables})
        refresh(spark, frames, out_dir, *rest)

    monkeypatch.setattr(sinks, "full_refresh", watched)
    after = queries.queries()["full_refresh_load"](spark, sf_dir)
    assert before[0] == {} and len(before[1]) == 4 and all(before[1].values())
    assert after.filter(F.col("table_name").isin(*schemas.HOURLY_TABLES)).isEmpty()


def test_arrivals_are_written_and_read_by_several_tasks(spark, plant, tmp_path, monkeypatch):
    from wattline import queries

    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = plant.enriched.repartition(4)
    monkeypatch.setattr(queries, "cut_lineage", lambda df, name: df)
    started = []

    def start(stream):
        result = hourly.state_energy_hourly(stream, queries.STREAM_DELAY)
        started.append(hourly.start_updates(result, f"{tmp_path}/log", f"{tmp_path}/checkpoint"))
        return started[-1]

    queries._arriving(spark, rows, start)
    folders = [os.listdir(f"{tmp_path}/arrivals/{n}") for n in range(queries.STREAM_ARRIVALS)]
    assert all(sum(name.endswith(".parquet") for name in names) > 1 for names in folders)
    read = [sum(p["numInputRows"] > 0 for p in query.recentProgress) for query in started]
    assert read == [1] * queries.STREAM_ARRIVALS


def test_upsert_replaces_and_inserts(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(map(tuple, sinks.upsert(old, new, ["k"]).collect())) == [("a", 1), ("b", 3), ("c", 4)]


def _stream_input(spark, plant):
    path = scratch_path(spark, "arrivals")
    plant.enriched.repartitionByRange(6, "ts").sortWithinPartitions("ts").write.parquet(path)
    return path


@pytest.mark.parametrize(
    "build,batch,keys",
    [
        (hourly.state_energy_hourly, "energy_hourly", hourly.HOURLY_KEYS),
        (hourly.detailed_state_hourly, "detailed_hourly", hourly.DETAILED_KEYS),
    ],
)
def test_stream_updates_equal_the_batch(spark, plant, build, batch, keys):
    """Several micro-batches; changed hours appear in more than one of them."""
    arrivals, log = _stream_input(spark, plant), scratch_path(spark, "log")
    stream = build(hourly.enriched_stream(spark, arrivals, files_per_batch=1), "31 days")
    hourly.start_updates(stream, log, scratch_path(spark, "state")).awaitTermination()
    assert spark.read.parquet(log).select("batch").distinct().count() > 2
    got = hourly.latest(spark, log, keys)
    wanted = getattr(plant, batch)
    long = spark.read.parquet(log).count()
    before = sorted(map(str, got.collect()))
    hourly.compact(spark, log, keys)
    got = hourly.latest(spark, log, keys)
    assert sorted(map(str, got.collect())) == before
    assert [d for d in os.listdir(log) if d.startswith("part=b")] == []
    assert spark.read.parquet(log).count() == len(before) <= long
    names = wanted.columns
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, wanted.select(names).collect()))


def test_stream_append_writes_closed_hours_once(spark, plant):
    path, out = scratch_path(spark, "arrivals"), scratch_path(spark, "closed")
    plant.enriched.coalesce(1).write.parquet(path)
    stream = hourly.state_energy_hourly(hourly.enriched_stream(spark, path), "2 hours")
    hourly.start_append(stream, out, scratch_path(spark, "state")).awaitTermination()
    got = spark.read.parquet(out)
    wanted = plant.energy_hourly
    closed = wanted.join(got.select(hourly.HOURLY_KEYS), hourly.HOURLY_KEYS)
    assert 0 < got.count() < wanted.count()
    names = wanted.columns
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, closed.select(names).collect()))
    assert kpi.state_energy_summary_hourly(plant.enriched).count() == wanted.count()


def test_stored_inputs_follow_rewritten_files(spark, sf_dir, tmp_path):
    from wattline.sources import derived

    for table in ("events", "supplier", "part"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    before = derived.stored_tables(spark, str(tmp_path))
    assert derived.stored_tables(spark, str(tmp_path)) is before
    events = spark.read.parquet(f"{sf_dir}/events.parquet").limit(10)
    events.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert derived.stored_tables(spark, str(tmp_path))["energy_measurement"].count() == 10


def _counted(monkeypatch, name):
    """Calls of a function of `kpi`, counted."""
    calls, real = [], getattr(kpi, name)
    monkeypatch.setattr(kpi, name, lambda *args: calls.append(name) or real(*args))
    return calls


def test_hourly_tables_share_one_join(spark, plant, monkeypatch):
    out_dir = scratch_path(spark, "plant")
    joins = _counted(monkeypatch, "spine_left_joins")
    sinks.publish_hourly(spark, {**plant.tables, "energy_enriched": plant.enriched}, out_dir)
    assert len(joins) == 1
    for table, view in (("oee_energy_summary_hourly", plant.oee), ("regression_base_hourly", plant.base)):
        rows = store.read_table(spark, out_dir, table)
        assert rows.count() == view.count() and rows.exceptAll(view.select(*rows.columns)).isEmpty()


def test_export_aligns_the_samples_once(spark, sf_dir, tmp_path, monkeypatch):
    copy = tmp_path / "sf"
    shutil.copytree(sf_dir, copy)
    # Nothing is stored yet of this folder.
    cubes = _counted(monkeypatch, "energy_cube")
    row = queries.queries()["export_run_metadata"](spark, str(copy)).collect()[0]
    assert len(cubes) == 1
    base = queries.Plant(spark, str(copy)).base
    assert row.raw_rows == base.count()
    assert row.aggregated_rows_after_filtering == kpi.aggregate_regression_input(base).count()


def test_arrivals_are_dealt_in_one_pass(spark, monkeypatch):
    """Days 1, 7 and 31, a late row of day 1, a row without time; arrivals that have no row exist too."""
    times = ["2024-01-01 00:00:01", "2024-01-01 00:00:04", "2024-01-07 05:00:00", "2024-01-31 05:00:00", None]
    number, seen = spark.sparkContext.accumulator(0), []
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schemas.ENERGY_ENRICHED])
    rows = [tuple(t and datetime.fromisoformat(t) if c == "ts" else None for c in loose.names) for t in times]

    def counted(batches):
        for batch in batches:
            number.add(batch.num_rows)
            yield batch

    enriched = spark.createDataFrame(rows, loose).mapInArrow(counted, loose)

    class Ended:
        def awaitTermination(self):
            pass

    def start(path):
        held = spark.read.schema(schemas.ENERGY_ENRICHED).parquet(path).select(F.col("ts").cast("string")).collect()
        seen.append({row.ts for row in held})
        return Ended()

    monkeypatch.setattr(queries, "cut_lineage", None)
    monkeypatch.setattr(queries.hourly, "enriched_stream", lambda spark, path: path)
    queries._arriving(spark, enriched, start)
    # The second row is the late one: its second is a multiple of seven.
    assert seen == [{times[0]}, *[{times[0], times[2]}] * 5, {*times}]
    assert number.value == len(times)
