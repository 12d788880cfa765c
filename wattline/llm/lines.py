"""Line dedup over overlapping three-line windows.

Every three consecutive lines of a document are one window. The first occurrence of a
window is the one with the smallest (document id, text, position), null ids last; all lines
that any later occurrence covers go. The first occurrence of each line always stays, since a
window that covers it would have an earlier occurrence holding the same line.

Cases: null texts stay null, texts under three lines stay as they are; windows of blank
lines only are no windows; rows that repeat both id and text count as one document and keep
the same lines; empty tables give empty results; all columns of the table are kept,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.columns import row_key
from wattline.session import cut_lineage

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(keyed: DataFrame) -> DataFrame:
    """(window, place) of each window; place orders all occurrences."""
    split = keyed.select("no_id", "id", "key", _lines(F.col("text")).alias("lines"))
    starts = F.when(
        F.size("lines") >= WINDOW, F.sequence(F.lit(0), F.size("lines") - WINDOW)
    ).otherwise(F.array().cast("array<int>"))
    joined = F.transform(starts, lambda at: F.array_join(F.slice("lines", at + 1, WINDOW), "\n"))
    # A null text has a null list; posexplode leaves it out.
    placed = split.select("no_id", "id", "key", F.posexplode(joined).alias("at", "window"))
    return placed.filter(F.regexp_like("window", F.lit(r"\S"))).select(
        F.unhex(F.md5("window")).alias("window"),
        F.struct("no_id", "id", "key", "at").alias("place"),
    )


def repeated_lines(keyed: DataFrame) -> DataFrame:
    """(key, covered): the line numbers to remove per document that has any."""
    placed = cut_lineage(occurrences(keyed), "line_windows")
    first = placed.groupBy("window").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    later = placed.join(first.filter("n > 1").select("window", "first"), "window").filter(
        F.col("place") != F.col("first")
    )
    return later.groupBy(F.col("place.key").alias("key")).agg(
        F.array_distinct(
            F.flatten(
                F.collect_set(F.sequence(F.col("place.at"), F.col("place.at") + WINDOW - 1))
            )
        ).alias("covered")
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, deduped, n_lines, n_removed): `row` holds all columns of the input row."""
    rows = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row"),
        docs[f"`{id_col}`"].alias("id"),
        docs[f"`{text_col}`"].alias("text"),
    )
    keyed = rows.withColumn("key", row_key(F.col("id"), F.col("text"))).withColumn("no_id", F.col("id").isNull())
    # Lines are split below the join, so that no later expression splits a text once per line.
    split = keyed.select("row", _lines(F.col("text")).alias("lines"), "key")
    marked = split.join(repeated_lines(keyed), "key", "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "covered")
    kept = F.transform(places, lambda at: F.get("lines", at))
    changed = F.col("covered").isNotNull()
    return marked.select(
        "row",
        F.when(changed, F.array_join(kept, "\n")).otherwise(F.col("row")[text_col]).alias("deduped"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(changed, F.size("covered")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
    )


def digest(deduped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row: id, line counts and SHA-256 of what stays."""
    return deduped.select(
        F.col("row")[id_col].alias("doc_id"),
        "n_lines",
        "n_removed",
        F.sha2(F.col("deduped"), 256).alias("text_sha256"),
    )
