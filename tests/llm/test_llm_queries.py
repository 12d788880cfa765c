"""Registered text queries: against their SQL, brute force, exact round trips or held-out labels."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter

import brute
import compare
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

import corpus_pipeline
from wattline.llm import bpe, language, oracles, quality_model, queries

SF = "/root/testdata/sf0.01"
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare.differences(df, con, ORACLES[name]) == []


@pytest.mark.parametrize(
    "name", ["op3_decontamination", "op6_url_filter", "op8_quality_rules"]
)
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_ids_equal_the_tokenizer_library(spark, docs):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for row in docs:
        ids = library.encode_ordinary(row.text)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        expected.append(
            (row.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(row.text.encode()).hexdigest())
        )
    assert sorted(map(tuple, QUERIES["op2_bpe_round_trip"](spark, SF).collect())) == sorted(expected)


def test_page_text_is_the_article(spark):
    pages = {row.page_id: row for row in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op4_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for row in got:
        article = re.search(r"<article>(.*?)</article>", pages[row.page_id].html, re.S)[1]
        spaced = re.sub(r"</?(?:p|h1|br)[^>]*>", " ", article)
        assert row.text == " ".join(html.unescape(re.sub(r"<[^>]+>", "", spaced)).split())
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def _held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_languages_of_held_out_documents(spark, docs):
    got = {row.doc_id: row for row in QUERIES["op5_language_id"](spark, SF).collect()}
    assert set(got) == {row.doc_id for row in docs}
    assert all(got[row.doc_id].held_out == _held_out(row.doc_id) for row in docs)
    judged = [row for row in docs if _held_out(row.doc_id)]
    right = sum(got[row.doc_id].lang_pred == row.lang for row in judged)
    assert right >= 0.97 * len(judged)
    assert all(0 <= row.score <= 1 for row in got.values())


def test_quality_of_held_out_documents(spark):
    got = {row.doc_id: row for row in QUERIES["op9_quality_classifier"](spark, SF).collect()}
    labels = [row for row in spark.read.parquet(f"{SF}/labels.parquet").collect() if _held_out(row.doc_id)]
    right = sum(got[row.doc_id].predicted == row.quality for row in labels)
    assert right >= 0.9 * len(labels)
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7) for row in got.values())


def test_languages_equal_brute_force(spark, docs):
    counts: dict[str, Counter] = {}
    for row in docs:
        if not _held_out(row.doc_id):
            counts.setdefault(row.lang, Counter()).update(brute.letter_grams(row.text))
    profiles = {lang: brute.ranked_grams(own) for lang, own in counts.items()}
    assert profiles == language.learn_outside_fold(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {row.doc_id: row for row in QUERIES["op5_language_id"](spark, SF).collect()}
    for row in docs[:150]:
        lang, score = brute.language(row.text, profiles)
        assert got[row.doc_id].lang_pred == lang and got[row.doc_id].score == pytest.approx(score, abs=1e-12)


def test_quality_scores_equal_plain_numpy(spark, docs):
    known = {row.doc_id: row.quality for row in spark.read.parquet(f"{SF}/labels.parquet").collect() if row.quality in (0, 1)}
    learnt = [row for row in docs if row.doc_id in known and not _held_out(row.doc_id)]
    ids = spark.createDataFrame([(row.doc_id,) for row in learnt], "doc_id long")
    part = {r.doc_id: r.part for r in ids.selectExpr("doc_id", "pmod(xxhash64(doc_id, 'part'), 16) AS part").collect()}
    x = np.array([brute.statistics(row.text) for row in docs])
    at = {row.doc_id: place for place, row in enumerate(docs)}
    own = x[[at[row.doc_id] for row in learnt]]
    y = np.array([known[row.doc_id] for row in learnt], dtype=float)
    fits = np.array([part[row.doc_id] < 12 for row in learnt])
    scale = own.std(axis=0)
    random = np.random.default_rng(quality_model.SEED)
    frequencies = random.normal(scale=1 / quality_model.WIDTH, size=(x.shape[1], quality_model.FEATURES))
    phases = random.uniform(0, 2 * np.pi, quality_model.FEATURES)

    def mapped(rows):
        z = (rows - own.mean(axis=0)) / np.where(scale > 1e-12, scale, 1.0)
        return np.hstack([np.cos(z @ frequencies + phases) * np.sqrt(2 / quality_model.FEATURES), np.ones((len(rows), 1))])

    # Ridge as least squares with a row per weight that pulls it to zero.
    pull = np.sqrt(np.append(np.full(quality_model.FEATURES, quality_model.RIDGE), 1e-9))
    weights = np.linalg.lstsq(np.vstack([mapped(own[fits]), np.diag(pull)]), np.append(y[fits], np.zeros(len(pull))), rcond=None)[0]
    raw = mapped(own[~fits]) @ weights
    bins: dict[int, list[int]] = {}
    for place, value in enumerate(raw):
        bins.setdefault(math.floor(min(max(value, -1.0), 2.0) * quality_model.BINS), []).append(place)
    groups = sorted(bins.values(), key=lambda places: raw[places].mean())
    levels = brute.isotonic([y[~fits][g].mean() for g in groups], [float(len(g)) for g in groups])
    expected = np.clip(np.interp(mapped(x) @ weights, [raw[g].mean() for g in groups], levels), 0, 1)
    got = {row.doc_id: row.score for row in QUERIES["op9_quality_classifier"](spark, SF).collect()}
    assert [got[row.doc_id] for row in docs] == pytest.approx(expected.tolist(), abs=1e-6)


def test_components_equal_brute_force(spark, docs):
    got = sorted(map(tuple, QUERIES["op7_ngram_jaccard_join"](spark, SF).collect()))
    assert got == sorted(brute.components([(row.doc_id, row.text) for row in docs]))


def test_runs_equal_brute_force(spark, docs):
    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, SF).collect()))
    assert got == sorted(brute.run_digest(row.doc_id, row.text) for row in docs)
    assert sum(row[1] > 0 for row in got) > 50


def test_pieces_equal_the_tokenizer_library_and_fill_sequences(spark, docs):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for row in docs:
        ids = [*library.encode(row.text, add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            packed = b"".join(i.to_bytes(4, "little") for i in part)
            expected.append((row.doc_id, piece, start, len(part), zlib.crc32(packed)))
    got = [tuple(row) for row in QUERIES["op13_best_fit_packing"](spark, SF).collect()]
    assert sorted(row[:5] for row in got) == sorted(expected)
    sequences = brute.sequences((row[5], row[6], row[3]) for row in got)
    assert max(sequences.values()) <= 4096
    # No packing needs fewer than the tokens fill.
    assert len(sequences) <= -(-sum(row[3] for row in got) // 4096) + 1


def test_pipeline_stages_work_on_what_came_before(spark, docs, tmp_path):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE",
    ]
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {row.doc_id: row.text for row in docs}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(at))
        stage(spark, frame, SF).write.parquet(path)
        frame = spark.read.parquet(path)
        if name == "byte-level BPE":
            got = {row.doc_id: row.decoded_sha256 for row in frame.collect()}
            assert got == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in rows.items()}
            return
        assert frame.columns == corpus_pipeline.COLUMNS
        got = {row.doc_id: row.text for row in frame.collect()}
        if name == "line dedup":
            left = brute.line_dedup(list(rows.items()))
            rows = {d: t for d, t in left if t == rows[d] or t.strip()}
        elif name == "n-gram Jaccard join":
            firsts = {first for _, _, first in brute.components(list(rows.items()), 5, 80)}
            rows = {d: t for d, t in rows.items() if d in firsts}
        elif name == "benchmark decontamination":
            bad = {row[0] for row in brute.contamination(list(rows.items()), items) if row[-1]}
            rows = {d: t for d, t in rows.items() if d not in bad}
        assert got == rows
    raise AssertionError("no token stage")


def test_near_duplicate_stage_takes_five_words_and_80_percent(spark, docs):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    got = {row.doc_id for row in corpus_pipeline.near_duplicate_stage(spark, frame, SF).collect()}
    rows = [(row.doc_id, row.text) for row in docs]
    firsts = {first for _, _, first in brute.components(rows, 5, 80)}
    assert got == firsts < {first for _, _, first in brute.components(rows)}


def test_later_stages_work_on_what_the_near_duplicate_stage_keeps(spark, docs, tmp_path):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {row.doc_id: row.text for row in docs}
    firsts = {first for _, _, first in brute.components(list(rows.items()), 5, 80)}
    bad = {row[0] for row in brute.contamination(list(rows.items()), items) if row[-1]}
    stages = dict(corpus_pipeline.STAGES)
    for name in ("n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"):
        stages[name](spark, frame, SF).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
    got = {row.doc_id: row.decoded_sha256 for row in frame.collect()}
    assert got == {d: hashlib.sha256(rows[d].encode()).hexdigest() for d in firsts - bad}


def test_pipeline_run_is_its_stages(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < got.count() <= 200
