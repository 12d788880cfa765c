"""Queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    audit,
    bpe,
    decontam,
    html_text,
    jaccard,
    language,
    licences,
    lines,
    packing,
    quality_model,
    rules,
    runs,
    urls,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.license_scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_sentences", "n_known", F.array_join("licences", ",").alias("licences")
    )


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digest(bpe.decode(encoded, ranks))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontam.digest(decontam.contamination(docs, items))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.near_duplicates(_table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.cascade(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.line_dedup(_table(spark, sf_dir, "documents")))


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = audit.failed_filters(_table(spark, sf_dir, "documents"))
    return audit.audit(failed, _table(spark, sf_dir, "labels"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.detect_runs(runs.with_loops(_table(spark, sf_dir, "documents"))))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.digest(packing.pack(packing.token_pieces(_table(spark, sf_dir, "documents"), tokenizer)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": license_scan,
        "op2_bpe_round_trip": bpe_round_trip,
        "op3_decontamination": decontamination,
        "op4_html_extraction": html_extraction,
        "op5_language_id": language_id,
        "op6_url_filter": url_filter,
        "op7_ngram_jaccard_join": ngram_jaccard_join,
        "op8_quality_rules": quality_rules,
        "op9_quality_classifier": quality_classifier,
        "op10_line_dedup": line_dedup,
        "op11_filter_audit": filter_audit,
        "op12_periodic_runs": periodic_runs,
        "op13_best_fit_packing": best_fit_packing,
    }
