"""Column helpers shared by the KPI plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator in DOUBLE, 0 when the denominator is not positive."""
    bottom = denominator.cast("double")
    return F.when(bottom > 0, F.coalesce(numerator.cast("double"), F.lit(0.0)) / bottom).otherwise(F.lit(0.0))


def sum_where(condition: Column, value: Column) -> Column:
    """SUM of `value` over rows where `condition` is true, 0 when there are none."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("decimal(1,0)"))


def total(value: Column) -> Column:
    """SUM with 0 instead of NULL."""
    return F.coalesce(F.sum(value), F.lit(0).cast("decimal(1,0)"))


def as_double(*names: str) -> dict[str, Column]:
    """Casts for `withColumns`."""
    return {name: F.col(name).cast("double") for name in names}
