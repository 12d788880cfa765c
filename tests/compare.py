"""Compare a registered query with its DuckDB SQL, as sets of rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def differences(df, con, sql) -> list[str]:
    """Empty when columns, row count and values agree exactly."""
    columns, rows = spark_rows(df)
    result = con.execute(sql)
    other_columns = [d[0] for d in result.description]
    other = result.fetchall()
    out = []
    if sorted(columns) != sorted(other_columns):
        return [f"columns {sorted(columns)} != {sorted(other_columns)}"]
    if len(rows) != len(other):
        out.append(f"rows {len(rows)} != {len(other)}")
    left, right = _bag(columns, rows), _bag(other_columns, other)
    if left != right:
        only_left, only_right = list((left - right).elements()), list((right - left).elements())
        out.append(f"{len(only_left)} only in spark, {len(only_right)} only in sql; columns {sorted(columns)}")
        out += [f"  spark {r}" for r in sorted(only_left)[:3]] + [f"  sql   {r}" for r in sorted(only_right)[:3]]
    return out
