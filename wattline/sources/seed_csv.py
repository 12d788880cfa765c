"""CSV input: one file (or folder) per table, converted to the declared types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas
from wattline.functions import constants as k
from wattline.sources import readers

# Texts that mean "missing" in CSV input.
MISSING_WORDS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def scan_seed_csv(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """All columns of `<directory>/<table>.csv` as text; malformed rows stop the job that reads them."""
    return readers.scan_csv_text(spark, f"{directory}/{table}.csv")


def project_seed_columns(df: DataFrame, table: str) -> DataFrame:
    """The columns the table declares, by name and in its order; a missing one is an error."""
    return df.select(*schemas.BASE_TABLES[table].names)


def parse_bool(value: Column) -> Column:
    """Booleans in the accepted spellings; missing is False, anything else an error.

    Values are read as text, so 1 and 0 stay valid even where other rows are empty.
    """
    word = F.lower(F.regexp_replace(value.cast("string"), r"(?U)^\s+|\s+$", ""))
    return (
        F.when(value.isNull(), F.lit(False))
        .when(word.isin(k.TRUE_WORDS), F.lit(True))
        .when(word.isin(k.FALSE_WORDS), F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit("Invalid boolean value: "), value.cast("string"))).cast("boolean"))
    )


def null_if_missing(value: Column) -> Column:
    """NULL for the texts that mean missing."""
    return F.when(~value.isin(MISSING_WORDS), value)


def normalize_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the declared types with missing values as NULL.

    Wrong numbers or times fail the job (ANSI casts). Times may carry an
    offset and become UTC.
    """
    columns = []
    for f in schema.fields:
        value = null_if_missing(F.col(f.name))
        if isinstance(f.dataType, T.BooleanType):
            value = parse_bool(value)
        elif isinstance(f.dataType, T.TimestampNTZType):
            value = value.cast("timestamp").cast("timestamp_ntz")
        else:
            value = value.cast(f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def read_seed_table(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """Scan, project and convert one table."""
    projected = project_seed_columns(scan_seed_csv(spark, directory, table), table)
    return normalize_nulls(projected, schemas.BASE_TABLES[table])


def read_seed_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {table: read_seed_table(spark, directory, table) for table in schemas.BASE_TABLES}
