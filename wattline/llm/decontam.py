"""Benchmark decontamination by winnowing (native).

Of every ten neighbouring 4-grams of words the smallest hash is a fingerprint, so any
13 words that a document and a benchmark item share leave the same fingerprint in both.
Document fingerprints are joined with the distinct item fingerprints; each hit is
extended to the 13-word windows around it, and those are joined with the items' windows
word by word, which makes the result exact. Items of fewer words are one window of their
own length; their lengths are few (at most 12), and documents are cut to those lengths only
if such items exist.

Cases: null and empty texts have no words and no hits; items without words are never
found; equal item ids count once; equal texts share one key, so repeated rows get the same
result each; empty tables give no hits; other columns of both tables are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.columns import NOT_ALNUM, ascii_lower, grams, row_key, word_list, zip_shifted
from wattline.session import cut_lineage

WINDOW = 13
GRAM = 4
#: 4-grams per fingerprint: every 13 words hold ten of them.
SPAN = WINDOW - GRAM + 1


def words_of(text: Column) -> Column:
    """Lower-cased words: letters, digits and everything beyond ASCII."""
    return word_list(ascii_lower(text), NOT_ALNUM)


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _minima(hashes: Column) -> Column:
    """The smallest of each ten neighbours (2, 4, 8, then 8 and 8 overlapping)."""
    two = zip_shifted(hashes, 1, _least)
    four = zip_shifted(two, 2, _least)
    eight = zip_shifted(four, 4, _least)
    ten = zip_shifted(eight, SPAN - 8, _least)
    return F.slice(ten, 1, F.greatest(F.size(hashes) - (SPAN - 1), F.lit(0)))


def _hashed(table: DataFrame) -> DataFrame:
    """Adds `hashes` of the words and `grams`, step by step so that each is built once."""
    hashed = table.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))
    return hashed.withColumn("grams", grams(F.col("hashes"), GRAM))


def fingerprints(table: DataFrame) -> DataFrame:
    """Adds `marks`: the distinct fingerprints of `words`."""
    return _hashed(table).withColumn("marks", F.array_distinct(_minima(F.col("grams"))))


def _windows(words: Column, starts: Column, length: int) -> Column:
    return F.transform(starts, lambda at: F.array_join(F.slice(words, at + 1, length), " "))


def _starts(words: Column, length: int) -> Column:
    count = F.size(words) - (length - 1)
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, length, window): 13 words each, or the whole of a shorter item."""
    words = items.select(F.col(item_col).alias("item_id"), words_of(F.col(text_col)).alias("words"))
    size = F.size("words")
    long = F.explode(_windows(F.col("words"), _starts(F.col("words"), WINDOW), WINDOW))
    whole = words.filter((size > 0) & (size < WINDOW)).select(
        "item_id", size.alias("length"), F.array_join("words", " ").alias("window")
    )
    full = words.filter(size >= WINDOW).select("item_id", F.lit(WINDOW).alias("length"), long.alias("window"))
    return full.unionByName(whole).distinct()


def _candidates(marked: DataFrame, texts: DataFrame, windows: DataFrame, items: DataFrame, text_col: str) -> DataFrame:
    """(key, at, window) of document windows around a shared fingerprint."""
    item_marks = (
        fingerprints(items.select(words_of(F.col(text_col)).alias("words")))
        .select(F.explode("marks").alias("mark"))
        .distinct()
    )
    shared = (
        marked.select("key", F.explode("marks").alias("mark"))
        .join(cut_lineage(item_marks, "item_marks"), "mark", "left_semi")
        .groupBy("key")
        .agg(F.collect_set("mark").alias("shared"))
    )
    # A written table: a text that a third of all rows repeat can then be split over tasks in this join.
    shared = cut_lineage(shared, "shared_marks")
    around = _hashed(texts.join(shared, "key").withColumn("words", words_of(F.col("text"))))
    hits = F.filter(
        F.transform("grams", lambda mark, at: F.when(F.array_contains("shared", mark), at)),
        lambda at: at.isNotNull(),
    )
    last = F.size("words") - WINDOW
    reach = F.transform(
        "hits",
        lambda at: F.filter(
            F.sequence(at - (SPAN - 1), at), lambda start: (start >= 0) & (start <= last)
        ),
    )
    starts = around.withColumn("hits", hits).withColumn("starts", F.array_distinct(F.flatten(reach)))
    return starts.select(
        "key",
        F.explode(F.arrays_zip("starts", _windows(F.col("words"), F.col("starts"), WINDOW).alias("found"))).alias("w"),
    ).select("key", F.col("w.starts").alias("at"), F.col("w.found").alias("window"))


def _short_windows(texts: DataFrame, length: int) -> DataFrame:
    words = texts.select("key", words_of(F.col("text")).alias("words"))
    return words.select(
        "key", F.posexplode(_windows(F.col("words"), _starts(F.col("words"), length), length)).alias("at", "window")
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document row: n_words, n_hit, the sorted ids of the items found, contaminated.

    A word is hit if it lies in any occurrence of an item window; a document is
    contaminated if at least one word and at least 5 % of its words are hit.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        row_key(F.coalesce(F.col(text_col), F.lit(""))).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    marked = fingerprints(texts.withColumn("words", words_of(F.col("text"))))
    marked = cut_lineage(marked.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), "marks"), "marks")
    windows = cut_lineage(item_windows(items, item_col, item_text_col), "item_windows")
    lengths = [row[0] for row in windows.select("length").distinct().orderBy("length").collect()]
    known = windows.select("length", "window").distinct()
    found = []
    if WINDOW in lengths:
        found.append(_candidates(marked, texts, windows, items, item_text_col).withColumn("length", F.lit(WINDOW)))
    found += [_short_windows(texts, n).withColumn("length", F.lit(n)) for n in lengths if n < WINDOW]
    if not found:
        none = "key binary, at int, window string, length int"
        found = [docs.sparkSession.createDataFrame([], none)]
    hits = reduce(DataFrame.unionByName, found).join(known, ["length", "window"], "left_semi").distinct()
    hits = cut_lineage(hits, "hits")
    covered = hits.groupBy("key").agg(
        F.size(
            F.array_distinct(
                F.flatten(
                    F.collect_list(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1))
                )
            )
        ).cast("long").alias("n_hit")
    )
    named = (
        hits.select("key", "length", "window").distinct()
        .join(windows, ["length", "window"])
        .select("key", F.col("item_id").cast("string").alias("item_id"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    result = cut_lineage(covered.join(named, "key"), "contamination")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        marked.select("doc_id", "key", "n_words")
        .join(result, "key", "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def keep_clean(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """The rows of `docs`, all columns, that are not contaminated."""
    rows = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row"),
        row_key(F.coalesce(docs[f"`{text_col}`"], F.lit(""))).alias("key"),
    )
    keyed = rows.select("key", F.col("row")[text_col].alias("text"))
    judged = contamination(keyed, items, "key", "text", item_col, item_text_col)
    gone = judged.filter("contaminated").select(F.col("doc_id").alias("key")).distinct()
    return rows.join(cut_lineage(gone, "contaminated_texts"), "key", "left_anti").select("row.*")


def digest(found: DataFrame) -> DataFrame:
    """The result with the items as count and SHA-256."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
