"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import itertools
import random
import time
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
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
    shingles,
    urls,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_RANKS = public_tokenizers.path("word_bpe_49k.json")
#: Names that the operators use inside themselves.
CLASHES = ["key", "row", "words", "id", "class", "n", "token", "block", "window", "place", "hashes", "marks", "stats"]


def table(spark, rows):
    """(doc_id, text) with further columns under names that operators use themselves."""
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return frame.select("*", *[F.lit(at).alias(name) for at, name in enumerate(CLASHES)], F.lit("en").alias("lang"))


def bag(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def edge_rows():
    long = " ".join(f"word{at % 997}" for at in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "two words"), (7, long), (8, long),
        (9, "same text here"), (9, "same text here"), (9, "another text"), (None, "no id"), (None, "no id"), (None, None),
        (10, "Ünïcödé 中文 😀 \x00\x1c text"), (11, "a\nb\nc\nd\na\nb\nc"), (12, "a\nb\nc"), (13, "x\nx\nx\nx\nx"),
    ]


def run_all(docs, spark):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"))
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    return {
        1: licences.license_scan(docs),
        2: bpe.digest(bpe.decode(encoded, RANKS)),
        3: decontam.contamination(docs, items),
        4: html_text.extract(pages),
        5: language.identify(docs),
        6: urls.judge_urls(pages),
        7: jaccard.near_duplicates(docs),
        8: rules.cascade(docs),
        9: quality_model.classify(docs, labels),
        10: lines.line_dedup(docs),
        11: audit.failed_filters(docs),
        12: runs.detect_runs(docs),
        13: packing.pack(packing.token_pieces(docs, WORD_RANKS)).filter("piece = 0"),
    }


def test_every_operator_returns_each_row(spark):
    rows = edge_rows()
    docs = table(spark, rows)
    for number, result in run_all(docs, spark).items():
        ids = [(r.row.doc_id if number == 10 else r[0]) for r in result.collect()]
        assert sorted(ids, key=repr) == sorted((r[0] for r in rows), key=repr), number


def test_every_operator_takes_empty_tables(spark):
    for number, result in run_all(table(spark, []), spark).items():
        assert result.collect() == [], number


def test_licences_in_sequence(spark):
    mit = f"Copyright (c) 2020 A. Body\n\n{licences.SENTENCES['mit-grant']}\n\n{licences.SENTENCES['mit-keep']}"
    wrapped = mit.replace("free of charge, to", "free of charge,\nto").replace("included in", "included\n  in")
    rows = [
        (1, wrapped),
        (2, "Some words.\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0."),
        (3, "SPDX-License-Identifier: MIT\nimport os"),
        (4, "The MIT licence is short. It is not granted here."),
        (5, licences.SENTENCES["gpl-redistribute3"] + " " + licences.SENTENCES["gpl-warranty"] + " " + licences.SENTENCES["gpl-implied"]),
        (6, None),
    ]
    got = {row.doc_id: row.licences for row in licences.license_scan(table(spark, rows)).collect()}
    assert got == {1: ["MIT"], 2: ["Apache-2.0", "MIT"], 3: ["MIT"], 4: [], 5: ["GPL-3.0-or-later"], 6: []}


def test_earlier_rules_take_their_sentences(spark):
    known = {"a": "First sentence.", "b": "Second sentence."}
    ordered = [("both", ["a", "b"]), ("first", ["a"]), ("second", ["b"])]
    rows = [(1, "First sentence. Second sentence."), (2, "Second sentence. First sentence."), (3, "First sentence. x. Second sentence.")]
    got = {r.doc_id: r.licences for r in licences.license_scan(table(spark, rows), known, ordered).collect()}
    assert got == {1: ["both"], 2: ["first", "second"], 3: ["first", "second"]}


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=200), st.text(alphabet="aeinorst .é中", min_size=1, max_size=300))
def test_merges_equal_the_library(raw, text):
    ranks = _ranks()
    core = _library()._core_bpe
    for word in (raw, text.encode()):
        assert bpe.merge(word, ranks) == core.encode_single_piece(word)


def _ranks(kept={}):
    if not kept:
        kept.update(bpe.read_ranks(RANKS))
    return kept


def _library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(), special_tokens={})


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**31 - 1), max_size=50))
def test_numbers_round_trip(values):
    data, sizes = bpe._numbers_out(np.array(values, dtype=np.int64))
    assert bpe._numbers_in(np.frombuffer(data, dtype=np.uint8)).tolist() == values
    assert sizes.sum() == len(data)


@pytest.mark.parametrize("block_chars", [500, 1_000_000])
def test_ids_and_round_trip_of_odd_texts(spark, block_chars):
    random.seed(5)
    rows = edge_rows() + [
        (100 + at, "".join(random.choice("ab c'sé\n\t 1!\x1c\x85 日😀") for _ in range(random.randint(0, 200)))) for at in range(200)
    ] + [(400, "a" * 3000 + " " * 500 + "x"), (401, "'s't're it's WE'LL   lead\u3000w"), (402, "\ufeffb\u200bc ³½ ٣")]
    encoded = bpe.encode(table(spark, rows), RANKS, public_tokenizers.PATTERN, block_chars=block_chars)
    got = bpe.decode(encoded, RANKS).select("id", "ids", "decoded").collect()
    library = _library()
    expected = [
        (d, b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(t or "")), (t or "").encode()) for d, t in rows
    ]
    assert bag((i, bytes(a), bytes(b)) for i, a, b in got) == bag(expected)


def _contaminated(spark, rows, items):
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    got = decontam.contamination(table(spark, rows), frame).collect()
    assert bag((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got) == bag(
        brute.contamination(rows, items)
    )


def test_contamination_equals_brute_force(spark):
    random.seed(1)
    vocabulary = [f"w{at}" for at in range(60)] + ["É", "naïve", "42"]
    items = [(at, " ".join(random.choices(vocabulary, k=random.randint(0, 40)))) for at in range(30)]
    items += [(100, None), (101, ""), (102, items[3][1]), (None, "no id " * 9), (103, "short one"), (104, "W1, w2! w3")]
    rows = edge_rows()
    for at in range(200):
        words = random.choices(vocabulary, k=random.randint(0, 200))
        for _ in range(random.randint(0, 2)):
            part = (random.choice(items)[1] or "").split()
            cut = random.randint(0, max(len(part) - 13, 0))
            words[random.randint(0, len(words)) :][:0] = []
            place = random.randint(0, len(words))
            words[place:place] = part[cut : cut + random.randint(1, 30)]
        rows.append((1000 + at, " ".join(words).upper() if at % 3 else ", ".join(words)))
    # Null item ids have no text form; the SQL and the brute-force version leave them out alike.
    _contaminated(spark, rows, [item for item in items if item[0] is not None])


def test_contamination_without_long_items_or_any(spark):
    _contaminated(spark, edge_rows(), [(1, "one"), (2, "same text"), (3, "word1 word2 word3")])
    _contaminated(spark, edge_rows(), [])


def test_every_shared_window_has_a_shared_fingerprint(spark):
    random.seed(2)
    shared = [f"s{at}" for at in range(13)]
    rows = []
    for at in range(100):
        before = [f"b{random.random()}" for _ in range(random.randint(0, 30))]
        rows.append((at, " ".join([*before, *shared, *[f"a{random.random()}" for _ in range(random.randint(0, 30))]])))
    _contaminated(spark, rows, [(1, " ".join(["x"] * 5 + shared + ["y"] * 5))])


def test_line_dedup_equals_brute_force(spark):
    random.seed(4)
    rows = edge_rows()
    for at in range(300):
        rows.append((200 - at, "\n".join(random.choices(["a", "b", "c", "", " ", "long line here"], k=random.randint(0, 12)))))
    got = lines.line_dedup(table(spark, rows)).collect()
    assert bag((r.row.doc_id, r.deduped) for r in got) == bag(brute.line_dedup(rows))
    assert all(r.row["key"] == 0 for r in got)


def test_base_counts_equal_brute_force(spark):
    random.seed(6)
    rows = edge_rows() + [(50 + at, " ".join(random.choices("a b # |x\n".split(" "), k=random.randint(0, 80)))) for at in range(200)]
    rows.append((900, "p q r s t u v w " * 500))
    got = rules.cascade(table(spark, rows)).collect()
    expected = [(d, *brute.base_counts(t)) for d, t in rows]
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == bag(expected)


def test_cascade_order_does_not_change_the_verdict(spark):
    rows = [(at, t) for at, (_, t) in enumerate(edge_rows())] + [(100, "LOUD TEXT!! " * 30), (101, "# | # " * 40)]
    first = rules.cascade(table(spark, rows), rules.default_rules())
    second = rules.cascade(table(spark, rows), rules.default_rules()[::-1], sample_rows=3)
    assert bag(first.select("doc_id", "kept").collect()) == bag(second.select("doc_id", "kept").collect())


def test_rules_are_ordered_by_rejection_per_cost(spark):
    cheap = rules.Rule("cheap", F.col("n_words") > 1, F.lit(1))
    dear = rules.Rule("dear", F.col("n_words") > 0, F.lit(1000))
    never = rules.Rule("never", F.lit(False), F.lit(1))
    ordered = rules.ordered_rules(table(spark, edge_rows()), [never, dear, cheap])
    assert [rule.name for rule in ordered] == ["cheap", "dear", "never"]


def _near(rows):
    return bag(brute.components(rows))


def test_components_equal_brute_force(spark):
    random.seed(3)
    vocabulary = [f"w{at}" for at in range(400)]
    base = random.choices(vocabulary, k=150)
    rows = edge_rows()
    for at in range(400):
        words = base[:]
        for _ in range(random.randint(0, 9)):
            words[random.randrange(150)] = f"X{random.random()}"
        rows.append((5000 - at, " ".join(words)))
    for at in range(100):
        words = random.choices(vocabulary, k=random.randint(0, 40))
        rows.append((6000 + at, " \t".join(words)))
        rows.append((7000 + at, " ".join(["q", *words[1:]]).upper()))
    got = jaccard.near_duplicates(table(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert bag(got) == _near(rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14), st.integers(0, 14))
def test_components_are_merged_by_further_links(spark, edges, cut):
    edges = [(a, b) for a, b in edges if a != b]

    def links(some):
        return spark.createDataFrame([(b"%02d" % min(e), b"%02d" % max(e)) for e in some], "a binary, b binary")

    earlier = jaccard.components(links(edges[:cut]), "earlier")
    merged = jaccard.components(links(edges[cut:]), "merged", earlier)
    least = {node: node for edge in edges for node in edge}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert sorted((int(r["class"]), int(r["comp"])) for r in merged.collect()) == sorted(least.items())
    # Links inside of components change nothing, and nothing is computed for them.
    assert jaccard.components(links(edges), "again", merged) is merged


def test_connected_near_copies_are_not_paired_off(spark, monkeypatch):
    rng = random.Random(5)
    words, rows = [f"w{rng.randrange(10**6)}" for _ in range(300)], []
    for doc in range(240):
        # Each differs from the one before by a word: neighbours link, distant ones do not.
        words = [*words[:doc], f"x{doc}", *words[doc + 1 :]]
        rows.append((doc, " ".join(words)))
    tried, real = [], jaccard.cut_lineage

    def kept(df, name):
        written = real(df, name)
        if name == "pairs":
            tried.append(written.count())
        return written

    monkeypatch.setattr(jaccard, "cut_lineage", kept)
    got = jaccard.near_duplicates(table(spark, rows)).select("component_id").distinct().collect()
    assert [row.component_id for row in got] == [0]
    # The last round tries all pairs of different components that bitmaps allow; there is one component.
    assert tried[-1] == 0


@pytest.mark.parametrize("shingle, similar", [(5, 80), (4, 97)])
def test_components_of_other_shingles_equal_brute_force(spark, shingle, similar):
    random.seed(8)
    base = [f"w{at}" for at in range(120)]
    rows = edge_rows()
    for at in range(200):
        words = base[:]
        for _ in range(random.randint(0, 6)):
            words[random.randrange(120)] = f"X{random.random()}"
        rows.append((5000 - at, " ".join(words[random.randint(0, 12) :])))
    got = jaccard.near_duplicates(table(spark, rows), shingle=shingle, similar=similar)
    got = got.select("doc_id", "n_shingles", "component_id").collect()
    assert bag(got) == bag(brute.components(rows, shingle, similar))


def test_links_inside_components_equal_brute_force(spark):
    random.seed(9)
    base = [f"w{at}" for at in range(150)]
    rows = [(at, text) for at, (_, text) in enumerate(edge_rows())]
    for at in range(600):
        words = base[:]
        for _ in range(random.randint(0, 4)):
            words[random.randrange(150)] = f"X{random.randrange(50)}"
        rows.append((1000 + at, " ".join(words)))
    sets = {}
    for doc, text in rows:
        words = brute.spaced_words((text or "").lower())
        if words:
            key = frozenset(tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1)))
            sets.setdefault(key, set()).add(doc)
    links = {
        frozenset([min(sets[a]), min(sets[b])])
        for a in sets for b in sets
        if a != b and 100 * len(a & b) >= 90 * len(a | b)
    }
    members, pairs = jaccard.similar_classes(table(spark, rows))
    members, pairs = members.collect(), pairs.collect()
    assert sorted(r.doc_id for r in members) == sorted(d for d, _ in rows)
    least = {}
    for r in members:
        if r.n_shingles:
            least[bytes(r["class"])] = min(least.get(bytes(r["class"]), r.doc_id), r.doc_id)
    assert sorted(least.values()) == sorted(map(min, sets.values()))
    got = [frozenset([least[bytes(p.a)], least[bytes(p.b)]]) for p in pairs]
    assert len(got) == len(set(got)) and set(got) == links
    assert len(links) > 10 * len(sets)
    for r in members:
        assert r.n_links == (sum(least[bytes(r["class"])] in pair for pair in links) if r.n_shingles else 0)


def test_one_row_of_each_component_stays(spark):
    rows = [(3, "a b c d"), (2, "A b c d"), (2, "A b c d"), (5, ""), (5, ""), (6, None), (None, "a b c d"), (7, "z y x")]
    kept = jaccard.keep_one(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert bag((r.doc_id, r.text) for r in kept.collect()) == bag([(2, "A b c d"), (5, ""), (6, None), (7, "z y x")])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\tÉé", max_size=30), min_size=1, max_size=8))
def test_shingle_hashes_tell_words_apart(texts):
    encoded = [t.encode() for t in texts]
    hashed = [set(h.tolist()) for h in shingles.shingle_lists(encoded, 3)]
    plain = []
    for text in texts:
        words = brute.spaced_words(text)
        plain.append({tuple(words[i : i + 3]) for i in range(len(words) - 2)} or ({tuple(words)} if words else set()))
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(hashed[i] & hashed[j]) == len(plain[i] & plain[j])


def test_html_cases():
    text = html_text.main_text
    assert text("") == "" and text("<html><body></body></html>") == ""
    assert text("<p>a&amp;b<b>c</b> d<p>e") == "a&bc d e"
    page = """<body><header>Site</header><nav><a href=x>Home</a></nav>
    <div class="cookie-notice">We use cookies on this site to serve you better every day.</div>
    <article><h1>The title</h1><p>First   paragraph with&nbsp;enough words to count.<br>After the break.
    <form><p>Your mail</p></form><p>Second <a href=y>linked</a> paragraph, unclosed <b>bold
    <ul><li>one<li>two</ul><section class="comments"><p>Reader says hello to all of you here.</p></section></article>
    <aside>Related things to read next, many of them.</aside><footer>&copy; me</footer><script>var t="</p>";</script>"""
    assert text(page) == (
        "The title First paragraph with enough words to count. After the break. "
        "Second linked paragraph, unclosed bold one two"
    )
    plain = """<div id=wrap><div><ul><li><a href=a>Link one</a><li><a href=b>Link two</a></ul></div>
    <div><div><p>One two three four five six seven eight nine.</p><p>More words are here for you, again.</p></div>
    <div><p>Third paragraph, also long enough to matter here.</p></div></div></div>"""
    assert text(plain) == (
        "One two three four five six seven eight nine. More words are here for you, again. "
        "Third paragraph, also long enough to matter here."
    )


def test_text_in_links_stays_unless_it_is_a_list_of_links():
    page = """<body><article><h1>The title</h1><p>First paragraph with enough words to count as text.</p>
    <p><a href=a><b>A whole sentence is one link.</b></a></p>
    <p><a href=a>Two links</a> and <a href=b>hardly more</a></p>
    <table><tr><td><a href=a>Cell one</a> <a href=b>cell two</a></td></tr></table>
    <blockquote><ul><li><a href=a>Quoted one</a></li><li><a href=b>quoted two</a></li></ul></blockquote>
    <ul><li><a href=a>Item one</a>, <a href=b>two</a></li><li>and an item of words that no link holds</li></ul>
    <div><p><a href=a>Boxed</a> <a href=b>links</a></p></div>
    <ul><li><a href=a>Menu one</a></li><li><a href=b>Menu two</a></li></ul><div><a href=a>Menu</a> <a href=b>three</a></div>
    <p>Last paragraph, also long enough to matter here.</p></article></body>"""
    assert html_text.main_text(page) == (
        "The title First paragraph with enough words to count as text. A whole sentence is one link. "
        "Two links and hardly more Cell one cell two Quoted one quoted two "
        "Item one, two and an item of words that no link holds Boxed links "
        "Last paragraph, also long enough to matter here."
    )


def test_language_of_odd_texts(spark):
    rows = [(at, text) for at, text in enumerate([None, "", "123 !?", "the cat and the dog", "THE CAT AND THE DOG"])]
    english = spark.createDataFrame([(at, "the cat and the dog and the house", "en") for at in range(5)], "id long, text string, lang string")
    german = spark.createDataFrame([(at, "der hund und die katze und das haus", "de") for at in range(5)], "id long, text string, lang string")
    profiles = language.learn_profiles(english.union(german))
    assert list(profiles) == ["de", "en"]
    got = {r.doc_id: r for r in language.predict(table(spark, rows), profiles, ["doc_id"]).collect()}
    assert [got[at].lang_pred for at in range(5)] == ["und", "und", "und", "en", "en"]
    assert [got[at].score for at in range(3)] == [0.0, 0.0, 0.0] and got[3].score == got[4].score > 0.5
    unlearned = language.predict(table(spark, rows), {}, ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}


def test_out_of_place_distance():
    alphabet, _, grams, rank, counts = language._tops(["abab b"], 10)
    spelled = [language._spelled(int(g), alphabet) for g in grams]
    # b three times, then pairs and singles by count, length and code point
    assert spelled[0] == "b" and counts[0] == 3 and rank.tolist() == list(range(len(grams)))
    names, scores = language._judge(["abab b"], {"x": spelled, "y": spelled[::-1]}, 10)
    assert names == ["x"] and scores[0] == 1.0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 5)), min_size=1, max_size=30))
def test_pooled_is_monotone_and_keeps_the_mean(pairs):
    values, weights = (np.array(column, dtype=float) for column in zip(*pairs, strict=True))
    fitted = quality_model.pooled(values, weights)
    assert (np.diff(fitted) >= -1e-12).all()
    assert abs((fitted * weights).sum() - (values * weights).sum()) < 1e-9


def test_classifier_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_model.classify(table(spark, edge_rows()), labels).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.5, 0)}


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        (None, "", "", None),
        ("no scheme", "", "", None),
        ("http://A.com", "a.com", "", None),
        ("http://A.com/", "a.com", "/", "com/"),
        ("http://com/x?y#z", "com", "/x", "com/"),
        ("https://m.example.com/en/1", "m.example.com", "/en/1", "example.com/en/"),
        ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/"),
        ("https://a.www.example.com/en/1", "a.www.example.com", "/en/1", "www.example.com/en/"),
        ("x://notexample.com/en/", "notexample.com", "/en/", "com/"),
        ("x://a.net/es/", "a.net", "/es/", "net/es/"),
        ("x://a.net/es", "a.net", "/es", None),
        ("x://a.b://c", "a.b:", "//c", None),
    ],
)
def test_rules_of_a_url(spark, url, host, path, rule):
    pages = spark.createDataFrame([(1, url, None)], "page_id long, url string, html string")
    row = urls.judge_urls(pages).first()
    assert (row.host, row.path, row.rule) == (host, path, rule)
    assert row.verdict == ("block" if rule in ("example.com/en/", "net/es/", "net/fr/") else "allow")


def test_trust_and_distrust_walk_the_links(spark):
    def link(*hosts):
        return " ".join(f'<a HREF="http://{h.upper()}/p">x</a>' for h in hosts)

    pages = [
        (1, "http://good.com/", link("near.org", "self.org")), (2, "http://near.org/", link("far.org", "near.org")),
        (3, "http://far.org/", None), (4, "http://bad.net/es/", link("bad.org")), (5, "http://fan.org/", link("bad.net", "bad.net", "far.org")),
        (6, "http://fan.org/2", link("bad.net")), (6, "http://fan.org/2", link("bad.net")), (7, "http://lone.org/", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r.page_id, r.host): r.verdict for r in urls.judge_urls(frame).collect()}
    edges = {("good.com", "near.org"): 1, ("good.com", "self.org"): 1, ("near.org", "far.org"): 1, ("bad.net", "bad.org"): 1,
             ("fan.org", "bad.net"): 4, ("fan.org", "far.org"): 1}
    trust = brute.propagate({"good.com": 1.0}, edges, urls.STEPS, urls.DAMPING)
    against = brute.propagate({"bad.net": 1.0}, {(d, s): n for (s, d), n in edges.items()}, urls.STEPS, urls.DAMPING)
    for (page, host), verdict in got.items():
        if page in (1, 4):
            continue  # by rule
        excess = against.get(host, 0) - trust.get(host, 0)
        assert verdict == ("block" if excess > urls.THRESHOLD else "allow"), host
    assert got[(5, "fan.org")] == "block" and got[(3, "far.org")] == "allow"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4), st.integers(1, 9), st.sampled_from([1, 6, 24]))
def test_runs_equal_brute_force(docs, period, least):
    docs = [[*words, *(words[:period] * 5)] for words in docs]
    flat = np.array([word for words in docs for word in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(docs)), [len(words) for words in docs])
    expected, before = [], 0
    for words in docs:
        expected += [(start + before, length, p) for start, length, p in brute.runs(words, least)]
        before += len(words)
    assert [tuple(run) for run in runs.find_runs(flat, owner, least).tolist()] == expected


def test_runs_of_edge_texts(spark):
    loop = " ".join(f"w{at % 5000}" for at in range(100_000))
    rows = [
        (1, None), (2, ""), (3, "a " * 23), (4, "a " * 24), (4, "a " * 24), (5, "x " + "a b c d e f g h i " * 3 + "y"),
        (None, "a b " * 12), (6, loop), (7, "\x1c\u00a0 " * 24), (8, "a b " * 12 + "a a b " * 9),
    ]
    got = {}
    for row in runs.detect_runs(table(spark, rows)).collect():
        found = [tuple(run) for run in row.runs]
        words = brute.spaced_words(dict(rows)[row.id])
        assert row.n_words == len(words)
        got[row.id] = found
        if row.id != 6:
            assert found == brute.runs(words)
    assert got[6] == [(0, 100_000, 5000)] and got[3] == [] and got[4] == [(0, 24, 1)] and got[5] == [(1, 27, 9)]
    with pytest.raises(ValueError):
        runs.detect_runs(table(spark, rows), times=2)
    strongest = {row.doc_id: row for row in runs.digest(runs.detect_runs(table(spark, rows))).collect()}
    assert strongest[2].n_runs == 0 and strongest[2].start is None and strongest[4].exponent_milli == 24_000


def test_loops_are_put_in_by_id_alone(spark):
    rows = [(doc, "a b c d e f g h i j " * (doc % 7)) for doc in range(200)] + [(None, "a b"), (3, None)]
    got = runs.with_loops(table(spark, rows)).collect()
    expected = [(doc, brute.looped(doc, text)) for doc, text in rows]
    assert bag((row.doc_id, brute.spaced_words(row.text)) for row in got) == bag(expected)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ é'sΣſİ中½²_-.!\x1c\u00a0\u0301\t\n1<|>"), max_size=60))
def test_word_ids_equal_the_library(text):
    library, words = _word_library()
    got = np.frombuffer(words.of_text(text), dtype="<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


def _word_library(kept=[]):
    if not kept:
        library = tokenizers.Tokenizer.from_file(WORD_RANKS)
        kept.append((library, packing.WordIds(tokenizers.Tokenizer.from_file(WORD_RANKS))))
    return kept[0]


def test_word_ids_of_special_strings_and_forgotten_words():
    library, words = _word_library()
    kept, packing.KNOWN_WORDS = packing.KNOWN_WORDS, 3
    try:
        for text in ("a<|endoftext|>b <|startoftext|>", "don't I'VE we'll x'y 'tis", "one two three four five one two " * 3, "\ud800 é"[2:]):
            assert np.frombuffer(words.of_text(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    finally:
        packing.KNOWN_WORDS = kept


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_plans_hold_all_pieces_in_few_sequences(lengths):
    counted = Counter(lengths)
    sequences = packing.plan(list(counted), list(counted.values()), 12)
    held = Counter()
    for copies, content in sequences:
        assert copies > 0 and sum(length * each for length, each in content) <= 12
        for length, each in content:
            held[length] += copies * each
    assert held == counted
    assert sum(copies for copies, _ in sequences) <= brute.fewest_sequences(lengths, 12) + 1


def test_plan_grows_with_lengths_not_with_pieces():
    rng = np.random.default_rng(3)
    lengths = sorted(set(rng.integers(1, 4097, 500).tolist()))
    counts = [int(n) for n in rng.integers(10**9, 10**11, len(lengths))]
    sequences = packing.plan(lengths, counts)
    tokens = sum(length * n for length, n in zip(lengths, counts, strict=True))
    assert sum(copies for copies, _ in sequences) <= 1.02 * tokens / 4096
    assert len(sequences) < 20_000


def test_packing_of_edge_rows(spark):
    long = " ".join(f"word{at}" for at in range(9000))
    rows = [(1, None), (2, ""), (None, "one"), (None, "one"), (3, long), (3, long), (4, "end")] + [(9, "same text")] * 50
    got = packing.pack(packing.token_pieces(table(spark, rows), WORD_RANKS, capacity=64), capacity=64).collect()
    library, _ = _word_library()
    expected = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        expected += [(doc, at, 64 * at, tuple(ids[64 * at : 64 * at + 64])) for at in range(-(-len(ids) // 64))]
    assert bag((r.id, r.piece, r.start, tuple(np.frombuffer(r.ids, dtype="<u4").tolist())) for r in got) == bag(expected)
    sequences = brute.sequences((row.sequence_id, row.offset, row.length) for row in got)
    assert len(sequences) <= -(-sum(row.length for row in got) // 64) + 1


def test_tries_hold_texts_in_order_with_their_smallest_keys():
    rng = random.Random(4)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 9))) for _ in range(400)] + [b"shared" * 500 + b"x", b"shared" * 500]
    keys = [rng.choice([None, *range(50)]) for _ in texts]
    trie = audit.RadixTrie()
    terminals = [trie.insert(text, key) for text, key in zip(texts, keys, strict=True)]
    assert [trie.texts[at] for at in terminals] == texts
    for text, at in zip(texts, terminals, strict=True):
        held = [key for other, key in zip(texts, keys, strict=True) if other == text and key is not None]
        assert trie.least[at] == min(held, default=None)
    order = [(trie.texts[at], shared) for at, shared in trie.in_order()]
    assert [text for text, _ in order] == sorted(set(texts))
    for (one, _), (other, shared) in zip(order, order[1:], strict=False):
        assert one[:shared] == other[:shared] and one[: shared + 1] != other[: shared + 1]


def failures_by_hand(rows):
    least = {}
    for doc, text in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    out = []
    for doc, text in rows:
        text = text or ""
        words = brute.spaced_words(text)
        fails = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
        first = least.get(text)
        out.append((doc, fails + "E" * (first is not None and (doc is None or doc > first))))
    return out


@pytest.mark.parametrize("block_bytes", [24_000_000, 300])
def test_failed_filters_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(audit, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(audit, "CUT_BYTES", 100)
    rng = random.Random(5)
    shared = "the same beginning of many texts " * 20
    rows = edge_rows() + [(100 + at, shared + rng.choice("ABC#d") * rng.randint(1, 3)) for at in range(150)]
    rows += [(300 + at, " ".join(rng.choices("uvwxyz", k=120))) for at in range(30)] + [(-5, shared + "A"), (400, " ".join(map(str, range(300))))]
    rng.shuffle(rows)
    got = audit.failed_filters(table(spark, rows)).collect()
    assert bag((row.id, row.fails) for row in got) == bag(failures_by_hand(rows))


def test_audit_counts_every_order_by_hand(spark):
    rng = random.Random(6)
    rows = [(at, rng.choice(["x #", "A" * 30, "w " * 150, " ".join(map(str, range(200))), "", None, f"own {at} $ Q"])) for at in range(80)]
    langs = {at: rng.choice(["en", "de", None]) for at, _ in rows}
    labels = [(at, rng.choice([0, 1, None]), rng.choice([0, 1])) for at in range(0, 90, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    docs = spark.createDataFrame([(at, text, langs[at]) for at, text in rows], "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1)).withColumn("fails", F.lit("A"))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.audit(audit.failed_filters(docs), marks).collect()}
    fails = dict(failures_by_hand(rows))
    good = {at for at, quality, _ in labels if quality == 1}
    toxic = {at for at, _, bad in labels if bad == 1}
    worth, expected = Counter(), {}
    for part in {lang or "" for lang in langs.values()}:
        for order in itertools.permutations("ABCDE"):
            left = [at for at in fails if (langs[at] or "") == part]
            everyone = list(left)
            for step, letter in enumerate(order, 1):
                gone = [at for at in left if letter in fails[at]]
                redundant = sum(letter in fails[at] for at in everyone) - len(gone)
                left = [at for at in left if letter not in fails[at]]
                worth[part, letter] += len(gone)
                alone = sum(fails[at] == letter for at in everyone)
                lost = [len(good & set(gone)), len(toxic & set(gone))]
                expected[part, "".join(order), step] = (len(left), len(gone), redundant, alone, *lost)
    assert {key: value[:-1] for key, value in got.items()} == expected and len(got) == 3 * 600
    assert all(value[-1] == worth[key[0], key[1][key[2] - 1]] for key, value in got.items())


def test_line_dedup_takes_time_in_proportion_to_the_lines(spark):
    def seconds(lines_):
        text = "\n".join(f"line {at}" for at in range(lines_))
        docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
        begin = time.perf_counter()
        got = {row.doc_id: row for row in lines.digest(lines.line_dedup(docs)).collect()}
        assert (got[1].n_removed, got[2].n_removed, got[2].n_lines) == (0, lines_, lines_)
        return time.perf_counter() - begin

    seconds(1_000)
    few, many = seconds(10_000), seconds(100_000)
    assert many <= 20 * few


MPL2 = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""
GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2_ONLY = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; version 2 of the License."""
LGPL21 = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
BSD2 = """Copyright (c) 2020, A. Body

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
HEADERS = {
    "MPL-2.0": MPL2, "GPL-2.0-or-later": GPL2, "GPL-2.0": GPL2_ONLY, "LGPL-2.1-or-later": LGPL21, "BSD-2-Clause": BSD2,
    "BSD-3-Clause": BSD3, "Apache-2.0": APACHE,
}


@pytest.mark.parametrize("leader", ["", "# ", " * ", "// "])
def test_published_headers_are_recognised_wrapped_and_in_comments(spark, leader):
    rows = []
    for at, text in enumerate(HEADERS.values()):
        lines_ = [(leader + line).rstrip() for line in text.split("\n")]
        rows.append((at, "\n".join(["int x = 1;", "", *lines_, "", "return x;"])))
    got = {row.doc_id: row.licences for row in licences.license_scan(table(spark, rows)).collect()}
    assert got == {at: [name] for at, name in enumerate(HEADERS)}


def test_known_sentences_survive_their_own_cut():
    for text in licences.SENTENCES.values():
        parts = licences.parts_of(text)
        assert parts and all(licences.parts_of(part) == [part] for part in parts)


def test_article_parts_under_misleading_names_stay():
    text = "These are ordinary sentences of the article, long enough to be read, and no link is in them at all. "
    link = "".join(f'<a href="/{at}">Link number {at}</a> ' for at in range(6))
    parts = {
        f'<p class="legal">{text}</p>': True,
        f'<div class="related-work"><p>{text * 2}</p></div>': True,
        f'<p id="search">{text}</p>': True,
        f'<blockquote class="notice">{text}</blockquote>': True,
        f'<div class="share">{link}</div>': False,
        f'<div class="share-buttons">{link}</div>': False,
        f'<div class="related-posts"><ul><li>{link}</li></ul></div>': False,
        f'<div class="comments"><p>{text}</p></div>': False,
        f'<section id="comment-list"><p>{text}</p></section>': False,
        f'<div class="ad-banner"><p>{text}</p></div>': False,
        f'<p class="ad">{text}</p>': False,
    }
    for part, stays in parts.items():
        for around in ("article", "main", "div"):
            page = f"<html><body><{around}><h1>Title</h1><p>{text * 3}</p>{part}<p>{text * 3}</p></{around}></body></html>"
            got = html_text.main_text(page)
            assert got.startswith("Title These") and got.count("These are ordinary") == 6 + (stays * part.count("These are")), (around, part)
            assert "Link number" not in got


def test_ranks_are_the_same_by_one_number_and_by_three(monkeypatch):
    texts = ["abc abd abc", "", "zz zz y", "ünï " * 9]
    packed = language._tops(texts, 50)
    monkeypatch.setattr(language, "_COUNT_BITS", 1)
    for ours, theirs in zip(packed, language._tops(texts, 50), strict=True):
        assert ours.tolist() == theirs.tolist()
