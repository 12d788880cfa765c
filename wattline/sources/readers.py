"""Readers for the tables and files that stages hand to each other."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas


def _existing(read, path: str) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"missing input: {path}") from error
        raise


def scan_regression_base(spark: SparkSession, path: str) -> DataFrame:
    """The 22 columns of the hourly base in order of hour and machine."""
    base = _existing(spark.read.parquet, path).select(*schemas.REGRESSION_BASE_COLUMNS)
    return base.orderBy("bucket_start", "machine_id")


def scan_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text under the names of the header; a row of another length stops the job.

    Quoted line breaks stay inside their value. Only the header is read here.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    names = _existing(reader.csv, path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    strict = reader.schema(schema).option("mode", "FAILFAST").option("enforceSchema", False)
    # With pruned columns the parser would not see how many fields a row has.
    return strict.option("columnPruning", False).csv(path)


def scan_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The declared columns with their types; times with offset become UTC."""
    return scan_csv_text(spark, path).select(
        *[
            F.col(f.name).cast("timestamp").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def scan_regression_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported model input."""
    return scan_typed_csv(spark, path, schemas.REGRESSION_INPUT)


def scan_summary_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Summary documents, one per line, with their nested arrays."""
    return _existing(spark.read.schema(schema).json, path)
