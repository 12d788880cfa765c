"""Periodic run detection by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are identical),
of at least max(`LEAST`, `TIMES` * q) words, that no neighbouring word extends.

For each power of two m, words of a document get names such that equal names mark equal factors
of m words; a name of 2m words is the pair of names of its halves. A position proposes the
distance d to the successor of its factor, if both lie in 2m words (d <= m). Positions in a row
that propose the same d are an arithmetic progression's stretch: extended by the factor and its
copy it is a run of period d, and d is its smallest period, since a smaller one would have
brought a nearer successor. A run of period q is proposed at all of its positions where
m/2 < q <= m (two copies of a factor fit into three periods), so only such d count at m; that
makes every run appear exactly once.

Only positions whose factor occurs again within the document stay for the next power, so plain
text is done after a few of them. Texts are handled some at a time, whole.

Cases: null and empty texts have no words and no runs; rows are judged one by one, repeated
ones and null ids too; of equally strong runs the first, then the shortest period is the
strongest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import bound_batches
from wattline.llm.columns import word_list

#: Shortest run in words, and in periods.
LEAST, TIMES = 24, 3
#: Characters handled at once; a longer text is handled alone.
CHUNK_CHARS = 2_000_000

_SCHEMA = "id {id}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _names(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name, order): equal pairs share a name; `order` sorts by name and keeps positions rising."""
    order = np.lexsort((second, first)) if len(first) else np.zeros(0, dtype=np.int64)
    changed = np.ones(len(order), dtype=bool)
    changed[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    name = np.empty(len(order), dtype=np.int64)
    name[order] = np.cumsum(changed)
    return name, order


def find_runs(words: np.ndarray, document: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (first word, length, period) of all runs, by place.

    `words` are numbers of the words of several documents one after another, `document` the
    number of each word's document (rising). No run crosses documents.
    """
    total = len(words)
    longest = int(np.bincount(document).max()) if total else 0
    # Positions whose factor of `size` words occurs again, rising, and the names there.
    at = np.arange(total)
    name, order = _names(document, words)
    size, found = 1, []
    while len(at) and size < 2 * max(longest // times, 1):
        successor = np.full(len(at), -1, dtype=np.int64)
        same = name[order[1:]] == name[order[:-1]]
        successor[order[:-1][same]] = at[order[1:][same]] - at[order[:-1][same]]
        found.append(_stretches(at, successor, size, least, times))
        again = np.zeros(len(at), dtype=bool)
        again[order[:-1][same]] = True
        again[order[1:][same]] = True
        at, name = at[again], name[again]
        # The second half of the doubled factor has to be among them, in the same document.
        place = np.searchsorted(at, at + size)
        place[place == len(at)] = 0
        whole = (at[place] == at + size) & (document[at] == document[at[place]]) if len(at) else np.zeros(0, dtype=bool)
        pair = name[place[whole]]
        at, name = at[whole], name[whole]
        name, order = _names(name, pair)
        size *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _stretches(at: np.ndarray, successor: np.ndarray, size: int, least: int, times: int) -> np.ndarray:
    """Runs of the positions in a row whose successor is equally far, more than half a factor and at most one."""
    near = (successor > size // 2) & (successor <= size)
    at, successor = at[near], successor[near]
    if not len(at):
        return np.zeros((0, 3), dtype=np.int64)
    begins = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(successor) != 0)])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(at)) - 1
    period = successor[first]
    length = at[last] - at[first] + size + period
    rows = np.stack([at[first], length, period], axis=1)
    return rows[length >= np.maximum(least, times * period)]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for at, text in enumerate(texts):
        size = len(text or "")
        if at > start and held + size > CHUNK_CHARS:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def _judge(texts: list[str | None], least: int, times: int) -> tuple[list[int], list[list[dict]], list[str]]:
    """(words, runs, collapsed text) of each text."""
    split = [(text or "").encode("utf-8", "surrogatepass").split() for text in texts]
    numbers: dict[bytes, int] = {}
    words = np.fromiter((numbers.setdefault(word, len(numbers)) for one in split for word in one), dtype=np.int64)
    borders = np.concatenate([[0], np.cumsum([len(one) for one in split])]).astype(np.int64)
    document = np.repeat(np.arange(len(split)), np.diff(borders))
    found = find_runs(words, document, least, times)
    runs: list[list[dict]] = [[] for _ in split]
    dropped: dict[int, np.ndarray] = {}
    for (first, length, period), own in zip(found.tolist(), document[found[:, 0]].tolist(), strict=True):
        start = first - int(borders[own])
        runs[own].append({"start": start, "length": length, "period": period})
        if own not in dropped:
            dropped[own] = np.zeros(len(split[own]) + 1, dtype=np.int64)
        dropped[own][start + period] += 1
        dropped[own][start + length] -= 1
    kept = [
        one if own not in dropped else [one[at] for at in np.flatnonzero(np.cumsum(dropped[own])[:-1] == 0).tolist()]
        for own, one in enumerate(split)
    ]
    return [len(one) for one in split], runs, [b" ".join(one).decode("utf-8", "surrogatepass") for one in kept]


def detect_runs(
    docs: DataFrame, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, runs, collapsed): runs by start and period; `collapsed` joins by one space the words
    that no run contains after its first period. `times` is 3 or more."""
    if times < 3:
        raise ValueError("two copies of a factor fit into three periods and more only")
    bound_batches(docs.sparkSession)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _chunks(texts):
                n_words, runs, collapsed = _judge(texts[start:end], least, times)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(n_words, pa.int64()),
                        pa.array(runs, _RUN),
                        pa.array(collapsed, pa.string()),
                    ],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    return rows.mapInArrow(judged, _SCHEMA.format(id=docs.schema[id_col].dataType.simpleString()))


def with_loops(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) where every tenth document (by crc32 of its id) ends in a loop of its own words.

    With h the crc32 of the id as text, g = h / 10 and n words: word i from a = g % n on becomes
    word a + (i - a) % p, where p = 1 + (n - a) / (3 + g % 8). Other texts stay as they are; a
    null id is the empty text.
    """
    rows = docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.when(h % 10 == 0, word_list(F.col("text")))
    named = rows.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), words.alias("words"))
    n, a = F.size("words"), F.col("a")
    begun = named.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    loop = begun.withColumn("p", (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    return loop.select("doc_id", F.when(a.isNotNull(), _looped(n)).otherwise(F.col("text")).alias("text"))


def _looped(n: Column) -> Column:
    a, p = F.col("a"), F.col("p")
    period = F.slice("words", a + 1, p)
    copies = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
    return F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(copies, F.lit(1), n - a)), " ")


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the strongest one, and SHA-256 of all runs and of the collapsed text."""
    strongest = F.aggregate(
        "runs",
        F.col("runs")[0],
        # The greater length / period; of equal ones the earlier, as runs come by start and period.
        lambda best, run: F.when(
            run["length"] * best["period"] > best["length"] * run["period"], run
        ).otherwise(best),
    )
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    best = F.when(F.size("runs") > 0, strongest)
    rows = found.select("id", "runs", "collapsed", best.alias("best"), text.alias("lines"))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
