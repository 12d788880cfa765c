"""DuckDB SQL with the meaning of each registered query.

The SQL is written independently of the Spark plans: native ASOF joins, range
joins, per-machine windows. Named parts are put together as CTEs.
"""

from __future__ import annotations

import re

_TAGS = {"P": "termelő", "N": "nem termelő", "S": "nem termelő és áll"}
_LO, _HI = "TIMESTAMP '2024-01-08 05:00:00'", "TIMESTAMP '2024-01-22 17:00:00'"

PARTS: dict[str, str] = {}


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN ({bottom}) > 0 THEN CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE) ELSE 0.0 END"


# --- input tables -----------------------------------------------------------

PARTS["ev"] = """
SELECT event_id, ts, event_type, value, user_id // 10 AS machine_no, 'M' || (user_id // 10) AS machine_id
FROM events"""
PARTS["machine"] = """
SELECT 'M' || (s_suppkey + 1) AS machine_id, s_name AS machine_name, 'Maker ' || s_nationkey AS manufacturer,
       CAST(NULL AS VARCHAR) AS model, 'machining center' AS machine_type
FROM supplier"""
PARTS["operation"] = """
SELECT 'OP_' || p_partkey AS operation_id, p_name AS operation_name,
       CAST(1500 + p_size * 100 AS DECIMAL(10,2)) AS ideal_cycle_time_sec
FROM part"""
PARTS["state_mapping"] = """
SELECT * FROM (VALUES ('RUN', 'Running', 'termelő', NULL), ('IDLE', 'Idle', 'nem termelő', NULL),
  ('MICRO_STOP', 'Micro-stop', 'nem termelő', 'Performance'),
  ('FAILURE', 'Failure', 'nem termelő és áll', 'Availability'))
  AS t(detailed_state_code, detailed_state_name, state_tag, oee_loss_type)"""
PARTS["energy_measurement"] = """
SELECT ts, machine_id, CAST(value AS DECIMAL(10,3)) AS power_kw,
  CASE WHEN event_id % 17 <> 0 THEN
    CAST(CAST((CAST(floor(epoch(ts)) AS BIGINT) * 13 + machine_no * 1009) % 700000 AS DECIMAL(9,0))
         * CAST('0.001' AS DECIMAL(4,3)) AS DECIMAL(12,5)) END AS energy_kwh_cumulative,
  CASE WHEN event_id % 13 <> 0 THEN CAST(60 AS DECIMAL(10,3)) END AS sample_interval_sec
FROM ev"""
PARTS["coded"] = """
SELECT *, CASE WHEN event_type IN ('click', 'purchase') THEN 'RUN' WHEN event_type = 'view' THEN 'IDLE'
  WHEN event_type = 'signup' THEN 'MICRO_STOP' ELSE 'FAILURE' END AS code
FROM ev"""
PARTS["machine_state_event"] = """
SELECT c.ts + to_seconds(event_id * 37 % 1800) AS ts, machine_id, code AS detailed_state_code, sm.state_tag,
  CAST(NULL AS VARCHAR) AS reason_code,
  CASE WHEN event_id % 11 <> 0 THEN code = 'IDLE' AND event_id % 7 = 0 END AS is_planned_stop,
  CASE WHEN code = 'IDLE' AND event_id % 3 <> 0 THEN 'simple_waiting' END AS idle_reason
FROM coded c JOIN state_mapping sm ON sm.detailed_state_code = c.code"""
PARTS["cycle_starts"] = """
SELECT event_id, 'C' || event_id AS cycle_id, machine_id, 'OP_' || (event_id // 5 + 1) AS operation_id,
  ts + to_seconds(event_id * 53 % 3600) AS cycle_start_ts, 1800 + event_id % 200 * 37 AS own_sec,
  CASE WHEN event_id % 3 = 0 THEN 'scrap' ELSE 'good' END AS part_result,
  CASE WHEN event_id % 3 = 0 THEN 'tolerance' END AS scrap_reason
FROM ev"""
PARTS["cycle_event"] = """
SELECT cycle_id, machine_id, operation_id, cycle_start_ts,
  least(cycle_start_ts + to_seconds(own_sec),
        lead(cycle_start_ts) OVER (PARTITION BY machine_id ORDER BY cycle_start_ts)) AS cycle_end_ts,
  CAST(own_sec AS DECIMAL(10,3)) AS actual_cycle_time_sec, part_result, scrap_reason
FROM cycle_starts"""

# --- the same rows before cleaning -----------------------------------------

PARTS["raw_cycle_event"] = """
SELECT CASE WHEN event_id % 101 = 0 THEN 'C101' ELSE cycle_id END AS cycle_id,
  CASE WHEN event_id % 89 <> 0 THEN machine_id END AS machine_id, operation_id, cycle_start_ts,
  CASE WHEN event_id % 53 = 0 THEN cycle_start_ts ELSE cycle_start_ts + to_seconds(own_sec) END AS cycle_end_ts,
  CAST((own_sec - 1837) * 2000 AS DECIMAL(14,3)) AS actual_cycle_time_sec,
  CASE WHEN event_id % 37 = 0 THEN 'rework' ELSE part_result END AS part_result, scrap_reason
FROM cycle_starts"""
PARTS["raw_energy_measurement"] = """
SELECT ts, machine_id, CAST(power_kw - 5 AS DECIMAL(10,3)) AS power_kw, energy_kwh_cumulative,
  CASE WHEN power_kw < 1 THEN CAST(0 AS DECIMAL(10,3)) ELSE sample_interval_sec END AS sample_interval_sec
FROM energy_measurement"""
PARTS["raw_machine_state_event"] = """
SELECT ts, machine_id,
  CASE WHEN detailed_state_code = 'RUN' AND is_planned_stop IS NULL THEN 'WARMUP'
       ELSE detailed_state_code END AS detailed_state_code,
  CASE WHEN NOT (detailed_state_code = 'RUN' AND is_planned_stop IS NULL) THEN state_tag END AS state_tag,
  reason_code, is_planned_stop, idle_reason
FROM machine_state_event"""
PARTS["raw_operation"] = """
SELECT operation_id, operation_name,
  CAST((ideal_cycle_time_sec - 1700) * 100000 AS DECIMAL(14,2)) AS ideal_cycle_time_sec
FROM operation"""


# --- enrichment ---------------------------------------------------------------

for _raw in ("", "raw_"):
    PARTS[f"{_raw}lagged"] = f"""
SELECT *, lag(energy_kwh_cumulative) OVER (PARTITION BY machine_id ORDER BY ts) AS prev_energy_kwh
FROM {_raw}energy_measurement"""
    PARTS[f"{_raw}delta"] = f"""
SELECT ts, machine_id, power_kw,
  CASE WHEN energy_kwh_cumulative IS NOT NULL AND prev_energy_kwh IS NOT NULL
         AND energy_kwh_cumulative >= prev_energy_kwh
       THEN CAST(energy_kwh_cumulative - prev_energy_kwh AS DECIMAL(12,6))
       WHEN sample_interval_sec > 0 AND power_kw IS NOT NULL
       THEN CAST(power_kw * sample_interval_sec / 3600 AS DECIMAL(12,6)) END AS delta_energy_kwh
FROM {_raw}lagged"""
    PARTS[f"{_raw}stated"] = f"""
SELECT d.*, m.detailed_state_code, m.state_tag
FROM {_raw}delta d ASOF LEFT JOIN {_raw}machine_state_event m
  ON m.machine_id = d.machine_id AND m.ts <= d.ts"""
    PARTS[f"{_raw}energy_enriched"] = f"""
SELECT s.ts, s.machine_id, s.power_kw, s.delta_energy_kwh, s.detailed_state_code, s.state_tag, c.cycle_id
FROM {_raw}stated s LEFT JOIN {_raw}cycle_event c
  ON c.machine_id = s.machine_id AND s.ts >= c.cycle_start_ts AND s.ts < c.cycle_end_ts"""
PARTS["cycle_energy_summary"] = """
SELECT c.cycle_id, c.machine_id, c.operation_id, c.cycle_start_ts, c.cycle_end_ts,
  CAST(coalesce(sum(e.delta_energy_kwh), 0) AS DECIMAL(12,6)) AS cycle_energy_kwh, c.part_result
FROM cycle_event c LEFT JOIN energy_enriched e
  ON e.machine_id = c.machine_id AND e.ts >= c.cycle_start_ts AND e.ts < c.cycle_end_ts
GROUP BY ALL"""
PARTS["raw_cycle_energy_summary"] = """
SELECT c.cycle_id, c.machine_id, c.operation_id, c.cycle_start_ts, c.cycle_end_ts,
  CAST(coalesce(sum(d.delta_energy_kwh), 0) AS DECIMAL(12,6)) AS cycle_energy_kwh, c.part_result
FROM raw_cycle_event c LEFT JOIN raw_delta d
  ON d.machine_id = c.machine_id AND d.ts >= c.cycle_start_ts AND d.ts < c.cycle_end_ts
WHERE c.cycle_id IN (SELECT cycle_id FROM raw_cycle_event GROUP BY cycle_id HAVING count(*) = 1)
GROUP BY ALL"""

# --- hourly views ---------------------------------------------------------------

_SUMS = ",\n  ".join(
    ["coalesce(sum(delta_energy_kwh), 0) AS energy_total_kwh"]
    + [
        f"coalesce(sum(delta_energy_kwh) FILTER (WHERE state_tag = '{_TAGS[t]}'), 0) AS {name}"
        for t, name in (
            ("P", "energy_productive_kwh"),
            ("N", "energy_non_productive_kwh"),
            ("S", "energy_non_productive_stop_kwh"),
        )
    ]
)
_NON_PROD = "energy_non_productive_kwh + energy_non_productive_stop_kwh"
PARTS["seh_exact"] = f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, machine_id, {_SUMS}
FROM energy_enriched GROUP BY 1, 2"""
PARTS["seh"] = f"""
SELECT bucket_start, machine_id, CAST(energy_total_kwh AS DOUBLE) AS energy_total_kwh,
  CAST(energy_productive_kwh AS DOUBLE) AS energy_productive_kwh,
  CAST(energy_non_productive_kwh AS DOUBLE) AS energy_non_productive_kwh,
  CAST(energy_non_productive_stop_kwh AS DOUBLE) AS energy_non_productive_stop_kwh,
  {_ratio("energy_productive_kwh", "energy_total_kwh")} AS productive_energy_ratio,
  {_ratio(_NON_PROD, "energy_total_kwh")} AS non_productive_energy_ratio
FROM seh_exact"""
PARTS["detailed"] = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, machine_id, detailed_state_code, state_tag,
  count(*) AS sample_count, CAST(coalesce(sum(delta_energy_kwh), 0) AS DOUBLE) AS energy_kwh,
  CAST(sum(power_kw) AS DOUBLE) / count(power_kw) AS avg_power_kw,
  CAST(min(power_kw) AS DOUBLE) AS min_power_kw, CAST(max(power_kw) AS DOUBLE) AS max_power_kw
FROM energy_enriched GROUP BY 1, 2, 3, 4"""
# Streams lose the rows that come later than the watermark: every seventh second of the first five days.
PARTS["in_time"] = """
SELECT * FROM energy_enriched
WHERE NOT (ts < TIMESTAMP '2024-01-06 00:00:00' AND CAST(floor(epoch(ts)) AS BIGINT) % 7 = 0)"""
for _part in ("seh_exact", "seh", "detailed"):
    PARTS[f"stream_{_part}"] = PARTS[_part].replace("FROM energy_enriched", "FROM in_time").replace(
        "FROM seh_exact", "FROM stream_seh_exact"
    )
PARTS["machines"] = """
SELECT machine_id FROM machine UNION SELECT machine_id FROM energy_measurement
UNION SELECT machine_id FROM machine_state_event UNION SELECT machine_id FROM cycle_event"""
PARTS["bounds"] = """
SELECT machine_id, max(seen) AS max_bound_ts
FROM (SELECT machine_id, TIMESTAMP '1970-01-01' AS seen FROM machines
      UNION ALL SELECT machine_id, cycle_end_ts FROM cycle_event
      UNION ALL SELECT machine_id, ts FROM machine_state_event
      UNION ALL SELECT machine_id, ts FROM energy_measurement
      UNION ALL SELECT machine_id, ts + to_microseconds(CAST(sample_interval_sec * 1000000 AS BIGINT))
                FROM energy_measurement WHERE sample_interval_sec IS NOT NULL)
GROUP BY machine_id"""
PARTS["numbered"] = """
SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY ts) AS k FROM machine_state_event"""
PARTS["intervals"] = """
SELECT a.machine_id, a.ts AS start_ts, CASE WHEN b.k IS NULL THEN max_bound_ts ELSE b.ts END AS end_ts,
  a.detailed_state_code, a.state_tag, a.reason_code, a.is_planned_stop, a.idle_reason
FROM bounds JOIN numbered a USING (machine_id)
LEFT JOIN numbered b ON b.machine_id = a.machine_id AND b.k = a.k + 1
WHERE a.ts < CASE WHEN b.k IS NULL THEN max_bound_ts ELSE b.ts END"""
PARTS["calendar"] = """
SELECT unnest(range(CAST(date_trunc('day', lo) AS TIMESTAMP), hi, INTERVAL 1 HOUR)) AS bucket_start
FROM (SELECT min(start_ts) AS lo, max(end_ts) AS hi FROM intervals)"""
PARTS["hours"] = """
SELECT i.*, c.bucket_start
FROM calendar c JOIN intervals i ON i.start_ts < c.bucket_start + INTERVAL 1 HOUR AND c.bucket_start < i.end_ts"""
PARTS["bucketed"] = """
SELECT machine_id, bucket_start, CASE WHEN start_ts > bucket_start THEN start_ts ELSE bucket_start END AS interval_start,
  CASE WHEN date_diff('microsecond', bucket_start, end_ts) < 3600000000 THEN end_ts
       ELSE bucket_start + to_hours(1) END AS interval_end,
  detailed_state_code, state_tag, is_planned_stop, idle_reason
FROM hours"""
PARTS["sth"] = """
SELECT bucket_start, machine_id,
  CAST(coalesce(sum(inside) FILTER (WHERE running), 0) AS DOUBLE) / 1000000.0 AS planned_time_sec,
  CAST(coalesce(sum(inside) FILTER (WHERE running AND lost), 0) AS DOUBLE) / 1000000.0 AS availability_loss_sec
FROM (SELECT bucket_start, machine_id, is_planned_stop = false AS running,
        3600000000 - greatest(date_diff('microsecond', bucket_start, start_ts), 0)
          - greatest(date_diff('microsecond', end_ts, bucket_start + INTERVAL 1 HOUR), 0) AS inside,
        CASE detailed_state_code WHEN 'FAILURE' THEN true
          WHEN 'IDLE' THEN idle_reason IS NOT DISTINCT FROM 'simple_waiting' ELSE false END
          OR state_tag IS NOT DISTINCT FROM 'nem termelő és áll' AS lost
      FROM hours)
GROUP BY bucket_start, machine_id"""
PARTS["cycle_facts"] = """
SELECT time_bucket(INTERVAL 1 HOUR, cycle_start_ts) AS bucket_start, machine_id, part_result,
  (SELECT any_value(ideal_cycle_time_sec) FROM operation o WHERE o.operation_id = c.operation_id) AS ideal,
  actual_cycle_time_sec AS actual,
  (SELECT sum(cycle_energy_kwh) FROM cycle_energy_summary s WHERE s.cycle_id = c.cycle_id) AS energy
FROM cycle_event c WHERE operation_id IN (SELECT operation_id FROM operation)"""
PARTS["by_result"] = """
SELECT bucket_start, machine_id, part_result, count(*) AS n, sum(ideal) AS ideal, sum(actual) AS actual,
  sum(energy) AS energy
FROM cycle_facts GROUP BY ALL"""
PARTS["csh"] = """
SELECT bucket_start, machine_id, CAST(sum(n) AS BIGINT) AS total_parts,
  CAST(coalesce(sum(n) FILTER (part_result = 'good'), 0) AS BIGINT) AS good_parts,
  CAST(coalesce(sum(n) FILTER (part_result = 'scrap'), 0) AS BIGINT) AS scrap_parts,
  CAST(coalesce(sum(ideal), 0) AS DOUBLE) AS ideal_cycle_time_total_sec,
  CAST(coalesce(sum(actual), 0) AS DOUBLE) AS actual_cycle_time_total_sec,
  CAST(coalesce(sum(energy), 0) AS DOUBLE) AS total_cycle_energy_kwh,
  CAST(coalesce(sum(energy) FILTER (part_result = 'good'), 0) AS DOUBLE) AS good_cycle_energy_kwh,
  CAST(coalesce(sum(energy) FILTER (part_result = 'scrap'), 0) AS DOUBLE) AS scrap_cycle_energy_kwh
FROM by_result GROUP BY bucket_start, machine_id"""
PARTS["buckets"] = """
SELECT bucket_start, machine_id FROM seh UNION SELECT bucket_start, machine_id FROM sth
UNION SELECT bucket_start, machine_id FROM csh"""
PARTS["spine"] = """
SELECT b.bucket_start, b.machine_id, e.* EXCLUDE (bucket_start, machine_id),
  s.* EXCLUDE (bucket_start, machine_id), c.* EXCLUDE (bucket_start, machine_id)
FROM buckets b
LEFT JOIN seh e ON e.bucket_start = b.bucket_start AND e.machine_id = b.machine_id
LEFT JOIN sth s ON s.bucket_start = b.bucket_start AND s.machine_id = b.machine_id
LEFT JOIN csh c ON c.bucket_start = b.bucket_start AND c.machine_id = b.machine_id"""
_AVAIL = _ratio("planned_time_sec - coalesce(availability_loss_sec, 0)", "planned_time_sec")
_PERF = _ratio("ideal_cycle_time_total_sec", "actual_cycle_time_total_sec")
_QUAL = _ratio("good_parts", "total_parts")
PARTS["oee_view"] = f"""
SELECT bucket_start, machine_id, {_AVAIL} AS availability, {_PERF} AS performance, {_QUAL} AS quality,
  ({_AVAIL}) * ({_PERF}) * ({_QUAL}) AS oee,
  {_ratio("total_cycle_energy_kwh", "total_parts")} AS energy_per_part_kwh,
  {_ratio("good_cycle_energy_kwh", "good_parts")} AS energy_per_good_part_kwh,
  {_ratio("good_cycle_energy_kwh", "good_parts")} AS cycle_energy_per_good_part_kwh,
  {_ratio("coalesce(energy_total_kwh, 0)", "good_parts")} AS system_energy_per_good_part_kwh,
  {_ratio("scrap_cycle_energy_kwh", "scrap_parts")} AS energy_per_scrap_part_kwh,
  coalesce(energy_total_kwh, 0.0) AS energy_total_kwh
FROM spine"""
_SUM_COLUMNS = [
    "planned_time_sec",
    "availability_loss_sec",
    "ideal_cycle_time_total_sec",
    "actual_cycle_time_total_sec",
    "energy_total_kwh",
    "energy_productive_kwh",
    "energy_non_productive_kwh",
    "energy_non_productive_stop_kwh",
    "good_cycle_energy_kwh",
]
_COUNT_COLUMNS = ["total_parts", "good_parts", "scrap_parts"]
_RATIOS = f"""{_AVAIL} AS availability, {_PERF} AS performance, {_QUAL} AS quality,
  ({_AVAIL}) * ({_PERF}) * ({_QUAL}) AS oee,
  {_ratio("scrap_parts", "total_parts")} AS scrap_rate,
  {_ratio("good_cycle_energy_kwh", "good_parts")} AS cycle_energy_per_good_part_kwh,
  {_ratio("energy_total_kwh", "good_parts")} AS system_energy_per_good_part_kwh,
  {_ratio(_NON_PROD, "energy_total_kwh")} AS non_productive_energy_ratio"""
PARTS["filled"] = (
    "SELECT bucket_start, machine_id, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _COUNT_COLUMNS)
    + ", "
    + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _SUM_COLUMNS)
    + " FROM spine"
)
PARTS["base_view"] = f"SELECT *, {_RATIOS} FROM filled"
PARTS["rolled"] = (
    "SELECT time_bucket(INTERVAL 4 HOUR, bucket_start) AS bucket_start, machine_id, "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNT_COLUMNS)
    + ", "
    + ", ".join(f"CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DOUBLE) AS {c}" for c in _SUM_COLUMNS)
    + " FROM base_view GROUP BY 1, 2"
)
PARTS["input4h"] = f"SELECT *, {_RATIOS} FROM rolled WHERE good_parts >= 2"
PARTS["energy_stats"] = f"SELECT {_SUMS} FROM energy_enriched"
PARTS["cycle_stats"] = """
SELECT count(*) AS total_parts, count(*) FILTER (WHERE part_result = 'good') AS good_parts,
  count(*) FILTER (WHERE part_result = 'scrap') AS scrap_parts,
  coalesce(sum(cycle_energy_kwh), 0) AS total_cycle_energy_kwh,
  coalesce(sum(cycle_energy_kwh) FILTER (WHERE part_result = 'good'), 0) AS good_cycle_energy_kwh,
  coalesce(sum(cycle_energy_kwh) FILTER (WHERE part_result = 'scrap'), 0) AS scrap_cycle_energy_kwh,
  round(coalesce(stddev_pop(cycle_energy_kwh), 0), 6) AS cycle_energy_stddev_kwh
FROM cycle_energy_summary"""
_ENERGY_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SUM_COLUMNS[4:8])
PARTS["totals"] = f"""
SELECT {_ENERGY_DOUBLES},
  {_ratio("energy_productive_kwh", "energy_total_kwh")} AS productive_energy_ratio,
  {_ratio(_NON_PROD, "energy_total_kwh")} AS non_productive_energy_ratio,
  total_parts, good_parts, scrap_parts,
  {_ratio("total_cycle_energy_kwh", "total_parts")} AS energy_per_part_kwh,
  {_ratio("good_cycle_energy_kwh", "good_parts")} AS cycle_energy_per_good_part_kwh,
  {_ratio("scrap_cycle_energy_kwh", "scrap_parts")} AS energy_per_scrap_part_kwh,
  cycle_energy_stddev_kwh,
  {_ratio("energy_total_kwh", "good_parts")} AS system_energy_per_good_part_kwh
FROM energy_stats, cycle_stats"""


_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def with_parts(sql: str) -> str:
    """Prefix `sql` with the named parts it needs, in order."""
    needed: dict[str, None] = {}

    def visit(text: str, own: str = "") -> None:
        for word in _WORD.findall(text):
            if word in PARTS and word not in needed and word != own:
                visit(PARTS[word], word)
                needed[word] = None

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name].strip()})" for name in needed) + "\n" + sql


QUERIES: dict[str, str] = {}


def _violation(rule: str, table: str, key: str, detail: str, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS \"table\", {key} AS key, {detail} AS detail FROM {source}"
    )


def _checks() -> None:
    sample_key = "CAST(ts AS VARCHAR) || '|' || machine_id"
    cycle_key = "coalesce(cycle_id, 'NULL')"

    def rows(rule: str, table: str, key: str, column: str, bad: str) -> str:
        return _violation(
            rule, table, key, f"coalesce(CAST({column} AS VARCHAR), 'NULL')", f"raw_{table} WHERE {bad}"
        )

    QUERIES.update(
        dq_check_operation_ideal=rows(
            "operation_ideal", "operation", "operation_id", "ideal_cycle_time_sec", "ideal_cycle_time_sec <= 0"
        ),
        dq_check_power=rows("power", "energy_measurement", sample_key, "power_kw", "power_kw < 0"),
        dq_check_sample_interval=rows(
            "sample_interval", "energy_measurement", sample_key, "sample_interval_sec", "sample_interval_sec <= 0"
        ),
        dq_check_cycle_order=rows(
            "cycle_order", "cycle_event", cycle_key, "cycle_end_ts", "cycle_end_ts <= cycle_start_ts"
        ),
        dq_check_cycle_time=rows(
            "cycle_time", "cycle_event", cycle_key, "actual_cycle_time_sec", "actual_cycle_time_sec <= 0"
        ),
        dq_check_part_result=rows(
            "part_result", "cycle_event", cycle_key, "part_result", "part_result NOT IN ('good', 'scrap')"
        )
        + " UNION ALL "
        + rows(
            "part_result", "cycle_energy_summary", cycle_key, "part_result", "part_result NOT IN ('good', 'scrap')"
        ),
        dq_check_summary_order=rows(
            "summary_order", "cycle_energy_summary", cycle_key, "cycle_end_ts", "cycle_end_ts <= cycle_start_ts"
        ),
        dq_check_summary_energy=rows(
            "summary_energy", "cycle_energy_summary", cycle_key, "cycle_energy_kwh", "cycle_energy_kwh < 0"
        ),
        dq_overlapping_cycles=_violation(
            "overlapping_cycles",
            "cycle_event",
            cycle_key,
            "'earlier cycle ends ' || CAST(prev_end AS VARCHAR)",
            "(SELECT *, max(cycle_end_ts) OVER (PARTITION BY machine_id ORDER BY cycle_start_ts, cycle_end_ts "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM raw_cycle_event "
            "WHERE machine_id IS NOT NULL AND cycle_end_ts > cycle_start_ts) WHERE cycle_start_ts < prev_end",
        ),
    )

    keys = {
        "machine": ["machine_id"],
        "operation": ["operation_id"],
        "state_mapping": ["detailed_state_code"],
        "energy_measurement": ["ts", "machine_id"],
        "machine_state_event": ["ts", "machine_id"],
        "cycle_event": ["cycle_id"],
        "energy_enriched": ["ts", "machine_id"],
        "cycle_energy_summary": ["cycle_id"],
    }
    clean = {"machine", "state_mapping"}

    def source(table: str) -> str:
        return table if table in clean else f"raw_{table}"

    unique = []
    for table, columns in keys.items():
        key = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
        grouped = ", ".join(columns)
        empty = " OR ".join(f"{c} IS NULL" for c in columns)
        unique.append(
            _violation(
                "primary_key",
                table,
                key,
                "'rows=' || n",
                f"(SELECT {grouped}, count(*) AS n FROM {source(table)} GROUP BY {grouped}) WHERE n > 1 OR {empty}",
            )
        )
    dashboard = "regression_dashboard_summary"
    for rule, column in (("primary_key", "model_scope"), ("unique_order", "display_order")):
        counted = f"(SELECT {column}, count(*) AS n FROM each_report GROUP BY 1) WHERE n > 1"
        unique.append(_violation(rule, dashboard, f"CAST({column} AS VARCHAR)", "'rows=' || n", counted))
    QUERIES["dq_primary_keys"] = " UNION ALL ".join(unique)

    references = [
        ("energy_measurement", "machine_id", "machine"),
        ("machine_state_event", "machine_id", "machine"),
        ("machine_state_event", "detailed_state_code", "state_mapping"),
        ("cycle_event", "machine_id", "machine"),
        ("cycle_event", "operation_id", "operation"),
        ("energy_enriched", "machine_id", "machine"),
        ("energy_enriched", "detailed_state_code", "state_mapping"),
        ("energy_enriched", "cycle_id", "cycle_event"),
        ("cycle_energy_summary", "cycle_id", "cycle_event"),
        ("cycle_energy_summary", "machine_id", "machine"),
        ("cycle_energy_summary", "operation_id", "operation"),
    ]
    QUERIES["dq_foreign_keys"] = " UNION ALL ".join(
        _violation(
            "foreign_key",
            child,
            f"CAST({column} AS VARCHAR)",
            f"'{column}->{parent} rows=' || count(*)",
            f"{source(child)} c WHERE {column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {source(parent)} p WHERE p.{column} = c.{column}) GROUP BY {column}",
        )
        for child, column, parent in references
    )

    required = {
        "machine": ["machine_id", "machine_name"],
        "operation": ["operation_id", "operation_name", "ideal_cycle_time_sec"],
        "state_mapping": ["detailed_state_code", "detailed_state_name", "state_tag"],
        "energy_measurement": ["ts", "machine_id", "power_kw"],
        "machine_state_event": ["ts", "machine_id", "detailed_state_code", "state_tag"],
        "cycle_event": [
            "cycle_id",
            "machine_id",
            "operation_id",
            "cycle_start_ts",
            "cycle_end_ts",
            "actual_cycle_time_sec",
            "part_result",
        ],
        "energy_enriched": ["ts", "machine_id", "power_kw"],
        "cycle_energy_summary": [
            "cycle_id",
            "machine_id",
            "operation_id",
            "cycle_start_ts",
            "cycle_end_ts",
            "cycle_energy_kwh",
            "part_result",
        ],
    }
    QUERIES["dq_not_null"] = " UNION ALL ".join(
        _violation("not_null", table, f"'{c}'", "'nulls=' || n", f"(SELECT count(*) AS n FROM {source(table)} WHERE {c} IS NULL) WHERE n > 0")
        for table, columns in required.items()
        for c in columns
    ) + " UNION ALL " + _violation(
        "not_null", "regression_dashboard_summary", "'headline'", "'nulls=' || n",
        "(SELECT count(*) AS n FROM each_report WHERE right(g, 1) IN ('1', '3', '5', '7', '9')) WHERE n > 0",
    )

    decimals = [
        ("operation", "operation_id", "ideal_cycle_time_sec", 10, 2),
        ("energy_measurement", sample_key, "power_kw", 10, 3),
        ("energy_measurement", sample_key, "energy_kwh_cumulative", 12, 5),
        ("energy_measurement", sample_key, "sample_interval_sec", 10, 3),
        ("cycle_event", cycle_key, "actual_cycle_time_sec", 10, 3),
        ("energy_enriched", sample_key, "power_kw", 10, 3),
        ("energy_enriched", sample_key, "delta_energy_kwh", 12, 6),
        ("cycle_energy_summary", cycle_key, "cycle_energy_kwh", 12, 6),
    ]
    QUERIES["dq_decimal_range"] = " UNION ALL ".join(
        _violation(
            "decimal_range",
            table,
            key,
            f"'{c} decimal({p},{s}) ' || CAST({c} AS VARCHAR)",
            f"{source(table)} WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({p},{s})) IS NULL",
        )
        for table, key, c, p, s in decimals
    )


_checks()

_SAMPLE_DOUBLES = "ts, machine_id, CAST(power_kw AS DOUBLE) AS power_kw, CAST(delta_energy_kwh AS DOUBLE) AS delta_energy_kwh"
_SUMMARY_DOUBLES = (
    "cycle_id, machine_id, operation_id, cycle_start_ts, cycle_end_ts, "
    "CAST(cycle_energy_kwh AS DOUBLE) AS cycle_energy_kwh, part_result"
)
_ENRICHED_DOUBLES = f"{_SAMPLE_DOUBLES}, detailed_state_code, state_tag, cycle_id"

QUERIES.update(
    lag_counter="SELECT ts, machine_id, CAST(energy_kwh_cumulative AS DOUBLE) AS energy_kwh_cumulative, "
    "CAST(prev_energy_kwh AS DOUBLE) AS prev_energy_kwh FROM lagged",
    delta_energy=f"SELECT {_SAMPLE_DOUBLES} FROM delta",
    asof_state_join="SELECT ts, machine_id, detailed_state_code, state_tag FROM stated",
    interval_cycle_join="SELECT s.ts, s.machine_id, c.cycle_id FROM energy_measurement s LEFT JOIN cycle_event c "
    "ON c.machine_id = s.machine_id AND s.ts >= c.cycle_start_ts AND s.ts < c.cycle_end_ts",
    interval_overlapping_cycle_join="SELECT s.ts, s.machine_id, c.cycle_id FROM energy_measurement s "
    "LEFT JOIN raw_cycle_event c "
    "ON c.machine_id = s.machine_id AND s.ts >= c.cycle_start_ts AND s.ts < c.cycle_end_ts",
    energy_enriched=f"SELECT {_ENRICHED_DOUBLES} FROM energy_enriched",
    cycle_energy_join="SELECT c.cycle_id, e.ts, CAST(e.delta_energy_kwh AS DOUBLE) AS delta_energy_kwh "
    "FROM cycle_event c LEFT JOIN energy_enriched e "
    "ON e.machine_id = c.machine_id AND e.ts >= c.cycle_start_ts AND e.ts < c.cycle_end_ts",
    cycle_energy_summary=f"SELECT {_SUMMARY_DOUBLES} FROM cycle_energy_summary",
    preview_enriched=f"SELECT {_ENRICHED_DOUBLES} FROM energy_enriched ORDER BY ts, machine_id LIMIT 10",
    preview_cycles=f"SELECT {_SUMMARY_DOUBLES} FROM cycle_energy_summary ORDER BY cycle_start_ts, cycle_id LIMIT 10",
    row_counts="SELECT 'energy_enriched' AS table_name, count(*) AS row_count FROM energy_enriched "
    "UNION ALL SELECT 'cycle_energy_summary', count(*) FROM cycle_energy_summary",
    state_energy_summary_hourly="SELECT * FROM seh",
    detailed_state_energy_summary_hourly="SELECT * FROM detailed",
    energy_cube="SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, machine_id, detailed_state_code, state_tag, "
    "cycle_id, CAST(sum(delta_energy_kwh) AS DOUBLE) AS delta_energy_kwh, count(*) AS sample_count, "
    "count(power_kw) AS power_count, CAST(sum(power_kw) AS DOUBLE) AS power_sum, "
    "CAST(min(power_kw) AS DOUBLE) AS power_min, CAST(max(power_kw) AS DOUBLE) AS power_max "
    "FROM energy_enriched GROUP BY 1, 2, 3, 4, 5",
    all_machines="SELECT machine_id FROM machines",
    machine_time_bounds="SELECT * FROM bounds",
    bounds_join="SELECT s.machine_id, s.ts, s.detailed_state_code, b.max_bound_ts "
    "FROM machine_state_event s JOIN bounds b ON b.machine_id = s.machine_id",
    state_intervals="SELECT * FROM intervals",
    lateral_hours="SELECT * FROM hours",
    state_interval_bucketed="SELECT * FROM bucketed",
    state_time_hourly="SELECT * FROM sth",
    cycle_operation_join="SELECT c.cycle_id, c.machine_id, c.operation_id, "
    "CAST(o.ideal_cycle_time_sec AS DOUBLE) AS ideal_cycle_time_sec, "
    "CAST(c.actual_cycle_time_sec AS DOUBLE) AS actual_cycle_time_sec "
    "FROM cycle_event c JOIN operation o ON o.operation_id = c.operation_id",
    cycle_summary_left_join="SELECT c.cycle_id, c.machine_id, c.operation_id, c.cycle_start_ts, "
    "CAST(c.actual_cycle_time_sec AS DOUBLE) AS actual_cycle_time_sec, c.part_result, "
    "CAST(s.cycle_energy_kwh AS DOUBLE) AS cycle_energy_kwh "
    "FROM cycle_event c LEFT JOIN cycle_energy_summary s ON s.cycle_id = c.cycle_id",
    cycle_stats_hourly="SELECT * FROM csh",
    all_buckets="SELECT * FROM buckets",
    spine_left_joins="SELECT * FROM spine",
    oee_energy_summary_hourly="SELECT * FROM oee_view",
    regression_base_hourly="SELECT * FROM base_view",
    regression_input_4h="SELECT * FROM input4h",
    target_profile="SELECT target, min(value) AS min_value, max(value) AS max_value, "
    "round(avg(value), 6) AS mean_value FROM ("
    "SELECT 'system_energy_per_good_part_kwh' AS target, system_energy_per_good_part_kwh AS value FROM input4h "
    "UNION ALL SELECT 'cycle_energy_per_good_part_kwh', cycle_energy_per_good_part_kwh FROM input4h) GROUP BY 1",
    kpi_cross_join=f"SELECT {_ENERGY_DOUBLES}, total_parts, good_parts, scrap_parts, "
    "CAST(total_cycle_energy_kwh AS DOUBLE) AS total_cycle_energy_kwh, "
    "CAST(good_cycle_energy_kwh AS DOUBLE) AS good_cycle_energy_kwh, "
    "CAST(scrap_cycle_energy_kwh AS DOUBLE) AS scrap_cycle_energy_kwh, cycle_energy_stddev_kwh "
    "FROM energy_stats, cycle_stats",
    kpi_totals="SELECT * FROM totals",
    kpi_invariants="""
SELECT unnest([
  {'rule': 'productive_energy_ratio in [0,1]', 'value': productive_energy_ratio,
   'ok': productive_energy_ratio BETWEEN 0 AND 1},
  {'rule': 'non_productive_energy_ratio in [0,1]', 'value': non_productive_energy_ratio,
   'ok': non_productive_energy_ratio BETWEEN 0 AND 1},
  {'rule': 'energy components sum to total', 'value': CAST(gap AS DOUBLE), 'ok': abs(gap) <= 0.000001},
  {'rule': 'good and scrap sum to total parts', 'value': CAST(good_parts + scrap_parts - total_parts AS DOUBLE),
   'ok': good_parts + scrap_parts = total_parts},
  {'rule': 'energy_total_kwh >= 0', 'value': energy_total_kwh, 'ok': energy_total_kwh >= 0},
  {'rule': 'energy_productive_kwh >= 0', 'value': energy_productive_kwh, 'ok': energy_productive_kwh >= 0},
  {'rule': 'energy_non_productive_kwh >= 0', 'value': energy_non_productive_kwh,
   'ok': energy_non_productive_kwh >= 0},
  {'rule': 'energy_non_productive_stop_kwh >= 0', 'value': energy_non_productive_stop_kwh,
   'ok': energy_non_productive_stop_kwh >= 0},
  {'rule': 'energy_per_part_kwh >= 0', 'value': energy_per_part_kwh, 'ok': energy_per_part_kwh >= 0},
  {'rule': 'cycle_energy_per_good_part_kwh >= 0', 'value': cycle_energy_per_good_part_kwh,
   'ok': cycle_energy_per_good_part_kwh >= 0},
  {'rule': 'energy_per_scrap_part_kwh >= 0', 'value': energy_per_scrap_part_kwh,
   'ok': energy_per_scrap_part_kwh >= 0},
  {'rule': 'cycle_energy_stddev_kwh >= 0', 'value': cycle_energy_stddev_kwh, 'ok': cycle_energy_stddev_kwh >= 0},
  {'rule': 'system_energy_per_good_part_kwh >= 0', 'value': system_energy_per_good_part_kwh,
   'ok': system_energy_per_good_part_kwh >= 0}], recursive := true)
FROM (SELECT t.*, (SELECT energy_productive_kwh + energy_non_productive_kwh + energy_non_productive_stop_kwh
                     - energy_total_kwh FROM energy_stats) AS gap FROM totals t)""",
)

_RANGE = f"BETWEEN {_LO} AND {_HI}"


def _means(names: list[str]) -> str:
    return (
        "SELECT " + ", ".join(f"round(avg({n}), 3) AS {n}" for n in names) + f" FROM oee_view WHERE bucket_start {_RANGE}"
    )


_OUTER = f"""
FROM (SELECT time_bucket(INTERVAL 1 HOUR, cycle_end_ts) AS h, count(*) FILTER (WHERE part_result = 'good') AS good,
        count(*) FILTER (WHERE part_result = 'scrap') AS scrap
      FROM cycle_event WHERE cycle_end_ts {_RANGE} GROUP BY 1) p
FULL OUTER JOIN (SELECT bucket_start AS h, CAST(sum(energy_total_kwh) AS DOUBLE) AS kwh
      FROM seh_exact WHERE bucket_start {_RANGE} GROUP BY 1) e ON p.h = e.h"""
QUERIES.update(
    panel_oee_gauge=_means(["oee", "availability", "performance", "quality"]),
    panel_energy_intensity=_means(
        [
            "energy_per_part_kwh",
            "cycle_energy_per_good_part_kwh",
            "energy_per_scrap_part_kwh",
            "system_energy_per_good_part_kwh",
        ]
    ),
    panel_state_share=f"""
SELECT CASE detailed_state_code WHEN 'RUN' THEN 'Termelés' WHEN 'IDLE' THEN 'Várakozás'
    WHEN 'MICRO_STOP' THEN 'Mikroleállás' WHEN 'FAILURE' THEN 'Hiba' ELSE detailed_state_code END AS allapot,
  CAST(round(sum(CAST(energy_kwh AS DECIMAL(28,6))), 3) AS DOUBLE) AS energia_kwh
FROM detailed WHERE bucket_start {_RANGE} GROUP BY 1 ORDER BY 2 DESC""",
    panel_state_timeseries=f"SELECT bucket_start AS time, detailed_state_code AS metric, energy_kwh "
    f"FROM detailed WHERE bucket_start {_RANGE} ORDER BY 1, 2",
    panel_category_timeseries=f'SELECT bucket_start AS time, energy_productive_kwh AS "Termelő energia", '
    f'energy_non_productive_kwh AS "Nem termelő energia", '
    f'energy_non_productive_stop_kwh AS "Nem termelő és áll energia" '
    f"FROM seh WHERE bucket_start {_RANGE} ORDER BY 1",
    parts_energy_full_outer=f'SELECT coalesce(p.h, e.h) AS time, good AS "Jó darab", scrap AS "Selejt darab", '
    f'kwh AS "Összes energia" {_OUTER}',
    panel_parts_vs_energy=f'SELECT coalesce(p.h, e.h) AS time, coalesce(good, 0) AS "Jó darab", '
    f'coalesce(scrap, 0) AS "Selejt darab", coalesce(kwh, 0.0) AS "Összes energia" {_OUTER} ORDER BY 1',
)


def _stacked(selects: dict[str, str]) -> str:
    return " UNION ALL BY NAME ".join(f"(SELECT '{t}' AS table_name, t.* FROM ({sql}) t)" for t, sql in selects.items())


_BASE = {
    "machine": "SELECT * FROM machine",
    "operation": "SELECT operation_id, operation_name, CAST(ideal_cycle_time_sec AS DOUBLE) AS ideal_cycle_time_sec "
    "FROM operation",
    "state_mapping": "SELECT * FROM state_mapping",
    "machine_state_event": "SELECT ts, machine_id, detailed_state_code, state_tag, reason_code, "
    "coalesce(is_planned_stop, false) AS is_planned_stop, idle_reason FROM machine_state_event",
    "cycle_event": "SELECT cycle_id, machine_id, operation_id, cycle_start_ts, cycle_end_ts, "
    "CAST(actual_cycle_time_sec AS DOUBLE) AS actual_cycle_time_sec, part_result, scrap_reason FROM cycle_event",
    "energy_measurement": "SELECT ts, machine_id, CAST(power_kw AS DOUBLE) AS power_kw, "
    "CAST(energy_kwh_cumulative AS DOUBLE) AS energy_kwh_cumulative, "
    "CAST(sample_interval_sec AS DOUBLE) AS sample_interval_sec FROM energy_measurement",
}
_DERIVED = {
    "energy_enriched": f"SELECT {_ENRICHED_DOUBLES} FROM energy_enriched",
    "cycle_energy_summary": f"SELECT {_SUMMARY_DOUBLES} FROM cycle_energy_summary",
}
_HOURLY = {
    "state_energy_summary_hourly": "SELECT * FROM seh",
    "detailed_state_energy_summary_hourly": "SELECT * FROM detailed",
    "oee_energy_summary_hourly": "SELECT * FROM oee_view",
    "regression_base_hourly": "SELECT * FROM base_view",
}
# A refresh stores the tables as given; only CSV turns a missing planned stop into false.
_STORED = {**_BASE, "machine_state_event": "SELECT * FROM machine_state_event"}
QUERIES.update(
    scan_seed_csv=_stacked(_BASE),
    project_seed_columns="SELECT ts, machine_id, CAST(power_kw AS DOUBLE) AS power_kw, "
    "CAST(energy_kwh_cumulative AS DOUBLE) AS energy_kwh_cumulative, "
    "CAST(sample_interval_sec AS DOUBLE) AS sample_interval_sec FROM energy_measurement",
    parse_bool="SELECT event_id, event_type <> 'error' AND event_id % 10 < 5 AS parsed FROM events",
    normalize_nulls="SELECT event_id, CASE WHEN event_type IN ('purchase', 'signup') "
    "THEN CAST(CAST(value AS DECIMAL(10,3)) AS DOUBLE) END AS value FROM events",
    scan_regression_base="SELECT * FROM base_view ORDER BY bucket_start, machine_id",
    scan_regression_csv="SELECT * FROM input4h",
    export_csv="SELECT * FROM base_view",
    export_run_metadata="SELECT 4 AS aggregation_hours, 2 AS min_good_parts_for_regression, "
    "'system_energy_per_good_part_kwh' AS primary_target, 'cycle_energy_per_good_part_kwh' AS secondary_target, "
    "(SELECT count(*) FROM base_view) AS raw_rows, (SELECT count(*) FROM input4h) AS aggregated_rows_after_filtering",
    full_refresh_load=_stacked({**_STORED, **{t: f"{sql} LIMIT 0" for t, sql in {**_DERIVED, **_HOURLY}.items()}}),
    rebuild_enriched=_stacked(_DERIVED),
    publish_hourly=_stacked(_HOURLY),
    publish_hourly_whole=_stacked(_HOURLY),
    refresh_published=_stacked({**_DERIVED, **_HOURLY}),
    stream_into_published=_stacked({**_DERIVED, **_HOURLY}),
    stream_energy_enriched=f"{_DERIVED['energy_enriched']} WHERE ts <= (SELECT date_trunc('milliseconds', greatest("
    "(SELECT max(ts) FROM energy_measurement), (SELECT max(ts) FROM machine_state_event), "
    "(SELECT max(cycle_start_ts) FROM cycle_event WHERE cycle_end_ts > cycle_start_ts))) - INTERVAL 3 DAY)",
    run_metadata="SELECT 'availability,performance,quality' AS features, "
    "'system_energy_per_good_part_kwh' AS primary_target, 'cycle_energy_per_good_part_kwh' AS secondary_target, "
    "(SELECT count(*) FROM mrows WHERE target = 'system_energy_per_good_part_kwh') AS primary_rows_used, "
    "(SELECT count(*) FROM mrows WHERE target = 'cycle_energy_per_good_part_kwh') AS secondary_rows_used",
    stream_state_energy_hourly="SELECT * FROM stream_seh",
    stream_detailed_state_hourly="SELECT * FROM stream_detailed",
    stream_closed_hours="SELECT * FROM stream_seh WHERE bucket_start + INTERVAL 1 HOUR <= "
    "(SELECT max(ts) - INTERVAL 2 DAY FROM energy_enriched)",
)


def oracle_sql() -> dict[str, str]:
    from wattline import oracles_models  # noqa: F401  registers the regression SQL

    return {name: with_parts(sql) for name, sql in QUERIES.items()}
