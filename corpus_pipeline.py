"""Training-text pipeline: five stages over `documents`, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bpe, decontam, jaccard, language, lines
from wattline.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Texts in any of the learned languages score 0.4 and more; below half of that is another script or no language.
LEAST_SCORE = 0.2
#: Near duplicates of the pipeline: word shingles of this length, similarity in percent.
NEAR_SHINGLE, NEAR_SIMILAR = 5, 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or near no profile go."""
    profiles = language.learn_outside_fold(docs)
    judged = language.predict(docs, profiles, COLUMNS)
    return judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; so does a document that keeps no line with text."""
    deduped = lines.line_dedup(docs.select(*COLUMNS))
    stays = (F.col("n_removed") == 0) | F.regexp_like("deduped", F.lit(r"\S"))
    return deduped.filter(stays).select(
        "row.doc_id",
        F.col("deduped").alias("text"),
        "row.lang",
        "row.source",
        F.when(F.col("n_removed") == 0, F.col("row.n_chars"))
        .otherwise(F.length("deduped"))
        .cast(docs.schema["n_chars"].dataType)
        .alias("n_chars"),
    )


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return jaccard.keep_one(docs.select(*COLUMNS), shingle=NEAR_SHINGLE, similar=NEAR_SIMILAR)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by a benchmark item."""
    return decontam.keep_clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digest(bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks))


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]

#: Language profiles and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
