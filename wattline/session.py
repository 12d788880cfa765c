"""Session defaults and the places where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Overflows and wrong casts stop a job instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "wattline", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the engine defaults; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hour borders are UTC borders (`date_trunc` follows the session zone), and ANSI errors are errors."""
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.ansi.enabled", "true")):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, taken from `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would lose its files together with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="wattline-")
    return _LOCAL_FOLDERS[application]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/wattline/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in the part of this application."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this application has left below the shared folder; call it when all results are read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` below the shared folder and read it back.

    A written table survives lost executors and gives the optimizer real sizes,
    so small results are broadcast by their measured size and not by a hint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
