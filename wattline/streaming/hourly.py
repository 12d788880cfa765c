"""Hourly energy kept up to date from a stream of enriched samples.

State is one row of sums per open (hour, machine[, state]); the watermark
closes hours. Rows that arrive later than the watermark are dropped: choose it
longer than the largest delay of the feed.

Two ways to store the results:
- `start_append` writes each hour once, when the watermark has closed it;
- `start_updates` writes every change at once into a log, from which
  `latest` takes the newest row of each key; `compact` shortens the log to those.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.plans import kpi
from wattline.schemas import ENERGY_ENRICHED

HOURLY_KEYS = ["bucket_start", "machine_id"]
DETAILED_KEYS = [*HOURLY_KEYS, "detailed_state_code", "state_tag"]


def enriched_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Enriched samples as files arrive in `path`; times as UTC instants, as watermarks need."""
    reader = spark.readStream.schema(ENERGY_ENRICHED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def _windowed(stream: DataFrame, watermark: str) -> DataFrame:
    return stream.withWatermark("ts", watermark).withColumn("bucket_start", F.window("ts", "1 hour"))


def _plain_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket_start", F.col("bucket_start.start").cast("timestamp_ntz"))


def state_energy_hourly(stream: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Streaming form of the hourly energy summary."""
    return _plain_hour(kpi.state_energy_summary_hourly(_windowed(stream, watermark)))


def detailed_state_hourly(stream: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Streaming form of the detailed hourly summary."""
    return _plain_hour(kpi.detailed_state_energy_summary_hourly(_windowed(stream, watermark)))


def start_append(result: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Each closed hour once, as parquet files."""
    writer = result.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(path)


def start_updates(result: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Changed hours of every micro-batch, one folder per batch; rows carry the number of their batch.

    A repeated batch overwrites its own folder, so a restart writes nothing twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{path}/part=b{batch_id}")

    writer = result.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _newest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in log.columns if c not in (*keys, "batch", "part")]
    newest = log.groupBy(*keys).agg(F.max(F.struct("batch", *values)).alias("_row"))
    return newest.select(*keys, "_row.*")


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key in an update log."""
    return _newest(spark.read.parquet(path), keys).drop("batch")


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Replace the folders of an update log by one that holds the newest row of each key.

    The new folder is complete before the old ones go. Rows keep the number of their batch, so
    a reader that meets both, or a batch that is repeated later, finds the same newest rows.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part=")]
    log = spark.read.option("basePath", path).parquet(*[p.toString() for p in old])
    _newest(log, keys).write.parquet(f"{path}/part=c{uuid.uuid4().hex}")
    for one in old:
        system.delete(one, True)
