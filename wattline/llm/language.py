"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent 1- to 3-grams of letters (words padded with a
blank, case folded by lower-casing), most frequent first, ties by code points. A document gets
the language whose profile is nearest by out-of-place distance: the sum over the document's
own most frequent n-grams of how far their ranks are apart, or the profile's length where the
profile lacks the n-gram. Texts are counted whole, a few at a time.

Profiles are learned from a bounded sample: `LEARN_ROWS` expected rows per language, picked
by a hash; with fewer rows all are used. Only profiles (rank lists) reach the driver.

Cases: null texts and texts without a letter get `und` with score 0; without any learning row
every document is `und`; equal distances go to the first language by name; rows are judged one
by one, repeated ones too; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.batches import bound_batches

#: n-grams in a profile and in a document's list.
PROFILE = 300
#: Expected number of learning rows per language.
LEARN_ROWS = 3_000
#: Characters counted at once; a longer text is counted alone.
CHUNK_CHARS = 400_000

#: Texts, counts and places that fit into one number of 63 bits.
_TEXT_BITS, _COUNT_BITS, _PLACE_BITS = 15, 24, 24


def held_out(id_col: Column) -> Column:
    """The contract's fold: crc32 of the id as text, modulo 4, is 2 (a null id is not)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 4 == 2


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > CHUNK_CHARS:
            yield start, at
            start, held = at, 0
        held += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(alphabet, codes, owner): letters as 1.., any run of others as one 0, per text."""
    lowered = [text.lower() for text in texts]
    points = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "replace"), dtype=np.uint32)
    seen = np.flatnonzero(np.bincount(points))
    alphabet = np.array([p for p in seen if chr(p).isalpha()], dtype=np.int64)
    table = np.zeros(int(seen[-1]) + 1, dtype=np.int64)
    table[alphabet] = np.arange(1, len(alphabet) + 1)
    codes = table[points]
    lengths = np.array([len(text) for text in lowered]) + 1
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), lengths)])
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return alphabet, codes[keep], owner[keep]


def _ngrams(alphabet: np.ndarray, codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, int]:
    """(text, n-gram) pairs as one sorted number each, and the number of possible n-grams.

    Order of numbers is order of length, then of code points.
    """
    base = len(alphabet) + 1
    possible = base + base**2 + base**3
    first, second = codes[:-1], codes[1:]
    pair = first * base + second + base
    whole = owner[1:] * possible
    single = codes[1:] != 0
    parts = [(whole + second)[single], (whole + pair)[(first != 0) | (second != 0)]]
    if len(codes) > 2:
        middle = codes[1:-1] != 0
        triple = (codes[:-2] * base + codes[1:-1]) * base + codes[2:] + base + base**2
        # A triple belongs to the text of its middle letter.
        parts.append((owner[1:-1] * possible + triple)[middle])
    keys = np.concatenate(parts)
    keys.sort()
    return keys, possible


def _tops(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(alphabet, text, n-gram, rank, count) of each text's `size` most frequent n-grams."""
    alphabet, codes, owner = _letters(texts)
    keys, possible = _ngrams(alphabet, codes, owner)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.array([], dtype=int)
    counts = np.diff(np.append(new, len(keys)))
    text, gram = np.divmod(keys[new], possible)
    starts = np.searchsorted(text, np.arange(len(texts) + 1))
    place = np.arange(len(text)) - starts[text]
    if max(counts.max(initial=0) >> _COUNT_BITS, place.max(initial=0) >> _PLACE_BITS, len(texts) >> _TEXT_BITS):
        order = np.lexsort((place, -counts, text))
        at = starts[text] + place[order]
    else:
        # The same order by one number, which sorts faster.
        most = (1 << _COUNT_BITS) - 1
        order = (text << (_COUNT_BITS + _PLACE_BITS)) | ((most - counts) << _PLACE_BITS) | place
        order.sort()
        at = starts[text] + (order & ((1 << _PLACE_BITS) - 1))
    rank = np.arange(len(text)) - starts[text]
    top = rank < size
    return alphabet, text[top], gram[at][top], rank[top], counts[at][top]


def _spelled(gram: int, alphabet: np.ndarray) -> str:
    """An n-gram's letters, blank for padding."""
    base = len(alphabet) + 1
    length, rest = (1, gram) if gram < base else (2, gram - base) if gram < base + base**2 else (3, gram - base - base**2)
    digits = [(rest // base**power) % base for power in range(length - 1, -1, -1)]
    return "".join(chr(alphabet[d - 1]) if d else " " for d in digits)


def _number(gram: str, position: dict[int, int], base: int) -> int | None:
    digits = [0 if letter == " " else position.get(ord(letter), -1) for letter in gram]
    if -1 in digits:
        return None
    value = 0
    for digit in digits:
        value = value * base + digit
    return value + (0, 0, base, base + base**2)[len(gram)]


def _count_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) for each chunk; the sums are Spark's."""
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(langs, texts, strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, own in by_lang.items():
            for start, end in _chunks(np.array([len(text) for text in own])):
                alphabet, _, grams, _, counts = _tops([" ".join(own[start:end])], 1 << 62)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": [lang] * len(grams),
                        "gram": [_spelled(int(g), alphabet) for g in grams],
                        "n": counts.astype(np.int64),
                    }
                )


def learn_profiles(rows: DataFrame, size: int = PROFILE, learn_rows: int = LEARN_ROWS) -> dict[str, list[str]]:
    """Profile by language from rows (id, text, lang); rows without text or lang are left out."""
    bound_batches(rows.sparkSession)
    known = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for lang, total in sorted(totals.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, learn_rows / total))).otherwise(share)
    dice = (F.xxhash64("id", "text").bitwiseAND(F.lit((1 << 32) - 1))) / float(1 << 32)
    sample = known.filter(dice < share).select("lang", "text")
    counted = sample.mapInArrow(_count_by_language, "lang string, gram string, n long")
    ranked = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # One window per language over its distinct n-grams, whose number the sample bounds.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.length("gram"), "gram")
    top = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    profiles: dict[str, list[str]] = {}
    for row in top.orderBy("lang", "rank").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def _judge(texts: list[str], profiles: dict[str, list[str]], size: int) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    langs = sorted(profiles)
    alphabet, text, grams, rank, _ = _tops(texts, size)
    total = np.bincount(text, minlength=len(texts))
    if not langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    position, base = {int(p): at for at, p in enumerate(alphabet, 1)}, len(alphabet) + 1
    distances = np.zeros((len(langs), len(texts)))
    for at, lang in enumerate(langs):
        numbered = sorted(
            (number, place)
            for place, gram in enumerate(profiles[lang])
            if (number := _number(gram, position, base)) is not None
        )
        apart = np.full(len(grams), float(size))
        if numbered:
            known, places = np.array(numbered).T
            found = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            hit = known[found] == grams
            apart[hit] = np.abs(places[found[hit]] - rank[hit])
        distances[at] = np.bincount(text, weights=apart, minlength=len(texts))
    best = distances.argmin(axis=0)
    score = 1 - distances[best, np.arange(len(texts))] / np.maximum(total * size, 1)
    names = [langs[b] if n else "und" for b, n in zip(best, total, strict=True)]
    return names, np.where(total > 0, np.clip(score, 0, 1), 0.0)


def predict(
    docs: DataFrame, profiles: dict[str, list[str]], keep: list[str], text_col: str = "text", size: int = PROFILE
) -> DataFrame:
    """The columns `keep` of each row with lang_pred and score."""
    bound_batches(docs.sparkSession)
    needed = keep if text_col in keep else [*keep, text_col]
    kept, place = len(keep), needed.index(text_col)
    chosen = docs.select(*[docs[f"`{name}`"] for name in needed])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(place).to_pylist()]
            names: list[str] = []
            scores: list[np.ndarray] = []
            for start, end in _chunks(np.array([len(text) for text in texts])):
                lang, score = _judge(texts[start:end], profiles, size)
                names += lang
                scores.append(score)
            columns = [batch.column(at) for at in range(kept)]
            columns += [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    fields = chosen.schema.fields[:kept]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "lang_pred string", "score double"])
    return chosen.mapInArrow(judge, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score (1: the profile's own order); learns outside the fold."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    return predict(plain, learn_outside_fold(docs, id_col, text_col, lang_col), ["doc_id", "held_out"])


def learn_outside_fold(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, list[str]]:
    """Profiles from the rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return learn_profiles(rows.filter(~held_out(F.col("id"))))
