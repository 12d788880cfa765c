"""Time arithmetic on `timestamp` and `timestamp_ntz` columns (UTC sessions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch as BIGINT."""
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def unit_start(df: DataFrame, ts: str, unit: str) -> Column:
    """Start of the hour, minute or second of `ts`, in the type of `ts`."""
    return F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType)


def hour_start(df: DataFrame, ts: str) -> Column:
    return unit_start(df, ts, "hour")


def seconds_later(ts: Column, seconds: Column) -> Column:
    """`ts` moved by a number of seconds, fractions included."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def micros_to_seconds(micros_sum: Column) -> Column:
    """Seconds as DOUBLE from a BIGINT sum; divided once, after summing."""
    return micros_sum.cast("double") / F.lit(float(MICROS_PER_SECOND))
