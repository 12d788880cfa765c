"""How many rows go to a Python worker at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Texts are long rows: so many of them are a few megabytes.
ROWS = 1_000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size for rows that carry texts; a smaller one stays."""
    held = int(spark.conf.get(_SETTING))
    if held <= 0 or held > ROWS:
        spark.conf.set(_SETTING, ROWS)
