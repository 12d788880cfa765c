"""Streams of samples, states and cycles merged into the published tables that panels read.

Each micro-batch is one `incremental.refresh`: new rows go to the base tables and the days that they
reach are replaced, late ones too, whatever their age. The pointer of the publication carries the
number of the batch, so a batch that is repeated after a restart finds itself published and changes
nothing. Several streams may feed one plant: whoever loses the race for the next version tries again
on top of the other's.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline import schemas
from wattline.plans import incremental
from wattline.sources import store

SERIES = "_series"
#: How often a batch is tried again when other publications come first.
TRIES = 5


def series_stream(spark: SparkSession, paths: Mapping[str, str], files_per_batch: int | None = None) -> DataFrame:
    """Rows of several series as files arrive in their folders, told apart by `_series`."""

    def one(table: str) -> DataFrame:
        reader = spark.readStream.schema(schemas.BASE_TABLES[table])
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(paths[table]).withColumn(SERIES, F.lit(table))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(table) for table in paths])


def publish_batch(
    spark: SparkSession,
    directory: str,
    batch: DataFrame,
    name: str,
    number: int,
    violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
) -> store.Snapshot:
    """Merge one batch of `series_stream` rows; a batch that is already published changes nothing."""
    rows = {table: batch.filter(F.col(SERIES) == table) for table in incremental.SERIES if _has(batch, table)}
    for attempt in range(TRIES):
        try:
            return incremental.refresh(spark, directory, rows, violations, note=(f"stream {name}", number))
        except store.PublicationConflict:
            if attempt == TRIES - 1:
                raise
    raise AssertionError


def _has(batch: DataFrame, table: str) -> bool:
    return set(schemas.BASE_TABLES[table].names) <= set(batch.columns)


def start_published(
    stream: DataFrame,
    directory: str,
    name: str,
    checkpoint: str,
    violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Keep the published plant in `directory` up to date from `stream`; `name` stands for its checkpoint."""

    def merge(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            publish_batch(batch.sparkSession, directory, held, name, number, violations)
        finally:
            held.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    return (writer.trigger(availableNow=True) if once else writer).start()
