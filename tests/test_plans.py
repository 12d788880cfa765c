"""KPI rules on small typed inputs and relations between results."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import quality
from wattline.plans import enrich, kpi

T0 = datetime(2026, 3, 1, 10, 0, 0)
STOP = "nem termelő és áll"


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def samples(spark, rows):
    full = [(t, "M", Decimal(p), None if c is None else Decimal(c), None if i is None else Decimal(i)) for t, p, c, i in rows]
    return spark.createDataFrame(full, schemas.ENERGY_MEASUREMENT)


def deltas(spark, rows):
    return [r.delta_energy_kwh for r in enrich.delta_energy(samples(spark, rows)).orderBy("ts").collect()]


def test_meter_reset_uses_power(spark):
    got = deltas(spark, [(at(0), "6.0", "100", "60"), (at(1), "6.0", "99", "60")])
    assert got == [Decimal("0.1"), Decimal("0.1")]


def test_delta_branches(spark):
    got = deltas(
        spark,
        [
            (at(0), "6.0", "100", None),  # first sample without interval
            (at(1), "6.0", "100", "60"),  # equal counters: zero, not the fallback
            (at(2), "6.0", None, "60"),  # no reading
            (at(3), "6.0", "105", "60"),  # the row before has no reading
            (at(4), "6.0", "107.5", "60"),
            (at(5), "6.0", "1", "0"),  # reset without a usable interval
        ],
    )
    assert got == [None, 0, Decimal("0.1"), Decimal("0.1"), Decimal("2.5"), None]


def test_fallback_keeps_digits(spark):
    # 123456.789 / 3600 is exactly 34.2935525: rounded half away from zero. Dividing the
    # interval first would leave 0.000277778 and give 34.293580.
    assert deltas(spark, [(at(0), "123456.789", None, "1")]) == [Decimal("34.293553")]


def states(spark, rows):
    full = [(t, "M", code, tag, None, planned, reason) for t, code, tag, planned, reason in rows]
    return spark.createDataFrame(full, schemas.MACHINE_STATE_EVENT)


def state_time(spark, rows, until):
    bounds = spark.createDataFrame([("M", until)], "machine_id string, max_bound_ts timestamp_ntz")
    bucketed = kpi.state_interval_bucketed(kpi.state_intervals(states(spark, rows), bounds))
    return {
        r.bucket_start: (r.planned_time_sec, r.availability_loss_sec)
        for r in kpi.state_time_hourly(bucketed).collect()
    }


def test_availability_loss_rules(spark):
    got = state_time(
        spark,
        [
            (at(0), "RUN", "termelő", False, None),
            (at(10), "FAILURE", STOP, False, None),  # loss
            (at(15), "IDLE", "nem termelő", False, "simple_waiting"),  # loss
            (at(20), "IDLE", "nem termelő", False, "tool_change"),
            (at(25), "IDLE", "nem termelő", True, "simple_waiting"),  # planned stop
            (at(30), "MICRO_STOP", "nem termelő", False, None),  # never a loss
            (at(40), "FAILURE", STOP, None, None),  # unknown planning: neither
            (at(50), "RUN", "termelő", False, None),
        ],
        at(60),
    )
    assert got == {at(0): (45 * 60.0, 10 * 60.0)}


def test_interval_ending_on_the_hour_opens_no_bucket(spark):
    got = state_time(spark, [(at(0), "RUN", "termelő", False, None)], at(120))
    assert got == {at(0): (3600.0, 0.0), at(60): (3600.0, 0.0)}


def test_bounds_take_sample_end_and_epoch(spark):
    measured = samples(spark, [(at(0), "1", None, "90"), (at(1), "1", None, None)])
    machine = spark.createDataFrame([("M", "m", None, None, None), ("X", "x", None, None, None)], schemas.MACHINE)
    none = spark.createDataFrame([], schemas.MACHINE_STATE_EVENT)
    cycles = spark.createDataFrame([], schemas.CYCLE_EVENT)
    got = {r.machine_id: r.max_bound_ts for r in kpi.machine_time_bounds(machine, measured, none, cycles).collect()}
    assert got == {"M": at(1.5), "X": datetime(1970, 1, 1)}


def test_four_hour_roll_up(spark):
    def hour(start, planned, loss, ideal, actual, parts, good, scrap, energy, prod, non, stop, good_energy):
        row = dict.fromkeys(schemas.REGRESSION_BASE_COLUMNS, 0.0)
        row.update(
            bucket_start=start,
            machine_id="M",
            planned_time_sec=float(planned),
            availability_loss_sec=float(loss),
            ideal_cycle_time_total_sec=float(ideal),
            actual_cycle_time_total_sec=float(actual),
            total_parts=parts,
            good_parts=good,
            scrap_parts=scrap,
            energy_total_kwh=float(energy),
            energy_productive_kwh=prod,
            energy_non_productive_kwh=float(non),
            energy_non_productive_stop_kwh=stop,
            good_cycle_energy_kwh=float(good_energy),
        )
        return tuple(row[c] for c in schemas.REGRESSION_BASE_COLUMNS)

    eight, ten = datetime(2026, 3, 1, 8), datetime(2026, 3, 1, 10)
    base = spark.createDataFrame(
        [
            hour(eight, 3600, 600, 1800, 2400, 3, 2, 1, 6, 4.5, 1, 0.5, 2),
            hour(ten, 3600, 300, 900, 1200, 2, 1, 1, 3, 2.25, 0.5, 0.25, 1),
            hour(datetime(2026, 3, 1, 12), 3600, 0, 1, 1, 1, 1, 0, 1, 1.0, 0, 0.0, 1),  # too few good parts
        ],
        schemas.REGRESSION_BASE,
    )
    (row,) = kpi.aggregate_regression_input(base).collect()
    assert row.bucket_start == eight
    assert (row.availability, row.performance, row.quality) == (0.875, 0.75, 0.6)
    assert row.oee == pytest.approx(0.39375)
    assert (row.scrap_rate, row.cycle_energy_per_good_part_kwh) == (0.4, 1.0)
    assert (row.system_energy_per_good_part_kwh, row.non_productive_energy_ratio) == (3.0, 0.25)


def test_hourly_sums_add_up_to_the_total(plant):
    (total,) = plant.by_hour.agg(F.sum("delta_energy_kwh")).first()
    (hourly,) = plant.energy_hourly.agg(F.sum(F.col("energy_total_kwh").cast("decimal(28,6)"))).first()
    assert hourly == total


def test_pieces_add_up_to_the_intervals(plant):
    seconds = F.sum(F.unix_micros(F.col("e").cast("timestamp")) - F.unix_micros(F.col("s").cast("timestamp")))
    whole = plant.intervals.select(F.col("start_ts").alias("s"), F.col("end_ts").alias("e")).agg(seconds).first()[0]
    cut = plant.bucketed.select(F.col("interval_start").alias("s"), F.col("interval_end").alias("e"))
    assert cut.agg(seconds).first()[0] == whole


def test_invariants_fail_with_and_pass_without_unknown_states(spark, plant):
    totals = kpi.kpi_totals(plant.cube, plant.summary)
    with pytest.raises(quality.KpiValidationError, match="components"):
        quality.assert_kpi_invariants(totals)
    known = plant.cube.filter(F.col("state_tag").isNotNull())
    quality.assert_kpi_invariants(kpi.kpi_totals(known, enrich.cycle_energy_summary(plant.cycles, known)))


def test_operation_time_is_summed_per_cycle(spark):
    cycles = spark.createDataFrame(
        [
            ("a", "M", "O1", at(0), at(5), Decimal(300), "good", None),
            ("b", "M", "O1", at(5), at(9), Decimal(240), "scrap", None),
            ("c", "M", "O2", at(9), at(10), Decimal(60), "good", None),
            ("d", "M", "gone", at(10), at(11), Decimal(60), "good", None),
        ],
        schemas.CYCLE_EVENT,
    )
    operation = spark.createDataFrame([("O1", "x", Decimal(200)), ("O2", "y", Decimal(50))], schemas.OPERATION)
    summary = spark.createDataFrame(
        [("a", "M", "O1", at(0), at(5), Decimal("1.5"), "good")], schemas.CYCLE_ENERGY_SUMMARY
    )
    (row,) = kpi.cycle_stats_hourly(cycles, operation, summary).collect()
    assert (row.total_parts, row.good_parts, row.scrap_parts) == (3, 2, 1)
    assert (row.ideal_cycle_time_total_sec, row.actual_cycle_time_total_sec) == (450.0, 600.0)
    assert (row.total_cycle_energy_kwh, row.good_cycle_energy_kwh, row.scrap_cycle_energy_kwh) == (1.5, 1.5, 0.0)


def test_deviation_and_means_have_the_same_bits_in_any_order(spark, plant):
    rng = random.Random(8)
    # Large values close together: a running mean of doubles would lose the deviation.
    values = [rng.choice([999_999, 123_456]) + rng.randrange(10**6) / 10**6 for _ in range(3000)]
    rows = [(f"c{at}", float(v), "good") for at, v in enumerate(values)]
    exact = [Fraction(round(v * 10**6), 10**6) for v in values]
    mean = sum(exact) / len(exact)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in exact) / len(exact))
    found = set()
    for parts in (1, 3, 7):
        rng.shuffle(rows)
        summary = spark.createDataFrame(rows, "cycle_id string, e double, part_result string").repartition(parts)
        summary = summary.select("cycle_id", F.col("e").cast("decimal(12,6)").alias("cycle_energy_kwh"), "part_result")
        found.add(kpi.kpi_totals(plant.cube, summary).first().cycle_energy_stddev_kwh)
    assert len(found) == 1 and found.pop() == pytest.approx(deviation, rel=1e-13)
    none = kpi.kpi_totals(plant.cube, summary.limit(0)).first()
    assert none.cycle_energy_stddev_kwh == 0.0
    profiles = {
        str(sorted(kpi.target_profile(plant.regression_input.repartition(parts)).collect())) for parts in (1, 5)
    }
    assert len(profiles) == 1
