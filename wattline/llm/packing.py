"""Best-fit packing: whole documents as token pieces in as few sequences as possible.

Every document becomes its token ids and an end id; only longer ones than a sequence are cut,
into pieces of full length and a rest. Which pieces share a sequence depends on their lengths
alone, so the packing is planned on the histogram of lengths (at most `CAPACITY` numbers,
whatever the table's size) and dealt out to the rows afterwards:

- Configuration linear program: a configuration says how many pieces of each length fill one
  sequence; the program asks for the fewest sequences that cover the histogram. Multiplicative
  weights hold a price per length and lower it as the length gets covered; each step prices
  configurations by knapsack dynamic programming, one best configuration around every length.
- Rounding: whole copies of the configurations, fullest first, as far as pieces are left; what
  remains goes best fit, longest first, still by counts.
- Rows: a task numbers its pieces within each length, numbers of (task, length) are summed up
  over the tasks, and each (task, length) gets the stretches of places it fills. Rows meet them
  by an equal join on (task, length); a length that a third of all rows share stays spread
  over the tasks.

A text is tokenized word by word (between ASCII white space, which the tokenizer drops), a word
once as long as a task remembers it; words and parts of words the task does not know go through
the tokenizer library.

Cases: null and empty texts are one piece, the end id; rows with equal or null ids are packed
each; equal lengths are dealt in the order of tasks; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import gc
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattline.llm.batches import bound_batches
from wattline.session import cut_lineage, scratch_path

#: Tokens in a sequence, and the id after each document.
CAPACITY, END_ID = 4096, 1
#: Words remembered by a task, and the longest word that is remembered (bounds of its memory).
KNOWN_WORDS, KNOWN_CHARS = 400_000, 64
#: Steps of the multiplicative weights, and how strongly a covered length loses weight.
STEPS, RATE = 40, 4.0
#: Configurations worth this share of the best one are taken into a step.
NEARLY = 0.995

_PIECES = "id {id}, piece int, start long, length int, ids binary, ids_crc32 long, block long, nth long"
_SEGMENTS = "block long, length int, segments array<struct<nth:long,first:long,sequence:long,each:int,offset:int>>"


# -- tokens ------------------------------------------------------------------------------------

#: Texts of these characters need no Unicode normalisation, and lower-casing maps each alone.
_PLAIN = re.compile("[\x09-\x0d\x20-\x7eÀ-įı-ſ]*")
#: The tokenizer's own split of a lower-cased word, for words of plain characters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def _byte_characters() -> str:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return "".join(chr(byte if byte in shown else 256 + hidden.index(byte)) for byte in range(256))


class _Known(dict):
    """Values by word, made when first asked for; forgotten all at once when there are too many."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, word):
        value = self._make(word)
        if len(word) <= KNOWN_CHARS:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = value
        return value


class WordIds:
    """Packed ids (little-endian, 32 bits each) of texts, word by word."""

    def __init__(self, tokenizer: Tokenizer):
        self._tokenizer, self._tokenize = tokenizer, tokenizer.model.tokenize
        self._special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self._bytes = _byte_characters()
        self._parts, self._plain, self._other = _Known(self._part), _Known(self._plain_word), _Known(self._other_word)

    def _part(self, part: bytes) -> bytes:
        """Ids of what the tokenizer's split leaves together."""
        shown = part.decode("ascii") if part.isascii() else part.decode("latin-1").translate(self._bytes)
        ids = [token.id for token in self._tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain_word(self, word: bytes) -> bytes:
        text, parts = word.decode(), self._parts
        if text.isalpha():
            return parts[word]
        if word[-1] < 128 and text[:-1].isalpha():
            return parts[word[:-1]] + parts[word[-1:]]
        return b"".join([parts[one.encode()] for one in _PARTS.findall(text)])

    def _other_word(self, word: bytes) -> bytes:
        text, tokenizer = word.decode("utf-8", "surrogatepass"), self._tokenizer
        if any(special in text for special in self._special):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if _PLAIN.fullmatch(text):
            return self._plain[text.lower().encode()]
        split = tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text))
        ids = [token.id for part, _ in split for token in self._tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def of_text(self, text: str | None) -> bytes:
        text = text or ""
        # Bytes split at ASCII white space alone.
        if _PLAIN.fullmatch(text) and not any(special in text for special in self._special):
            return b"".join(map(self._plain.__getitem__, text.lower().encode().split()))
        return b"".join(map(self._other.__getitem__, text.encode("utf-8", "surrogatepass").split()))


def _cut_pieces(tokenizer_json, capacity: int, end_id: int):
    """Pieces of each row, numbered within (task, length)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Nothing below makes reference cycles, and searching the remembered words for them is slow.
        gc.disable()
        words = WordIds(Tokenizer.from_str(tokenizer_json.value))
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64).tolist()
        end, width = int(end_id).to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            rows, number, start, length, ids, sums, nth = [], [], [], [], [], [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                data = words.of_text(text) + end
                for piece, begin in enumerate(range(0, len(data), width)):
                    part = data[begin : begin + width]
                    size = len(part) // 4
                    rows.append(at)
                    number.append(piece)
                    start.append(begin // 4)
                    length.append(size)
                    ids.append(part)
                    sums.append(zlib.crc32(part))
                    nth.append(seen[size])
                    seen[size] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.array(ids, pa.binary()),
                    pa.array(sums, pa.int64()),
                    pa.array([block] * len(rows), pa.int64()),
                    pa.array(nth, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids", "ids_crc32", "block", "nth"],
            )
        gc.enable()

    return pieces


# -- plan --------------------------------------------------------------------------------------


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, item): the best total price within each room, and the item to take there (-1: none)."""
    value, item = np.zeros(capacity + 1), np.full(capacity + 1, -1, dtype=np.int64)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        n = fits[room]
        value[room], item[room] = value[room - 1], item[room - 1]
        if n:
            total = value[room - sizes[:n]] + prices[:n]
            best = int(total.argmax())
            if total[best] > value[room]:
                value[room], item[room] = total[best], best
    return value, item


def _fill(first: np.ndarray, sizes: np.ndarray, item: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """The best configuration around each item of `first`, as sorted item numbers."""
    room, columns = capacity - sizes[first], [first]
    while True:
        chosen = item[room]
        if (chosen < 0).all():
            break
        columns.append(chosen)
        room = room - np.where(chosen >= 0, sizes[chosen], 0)
    table = np.sort(np.stack(columns, axis=1), axis=1)
    return [tuple(row[row >= 0].tolist()) for row in table]


def fractional_configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> dict[tuple[int, ...], float]:
    """Copies of configurations (tuples of item numbers) that nearly cover the counts."""
    copies: dict[tuple[int, ...], float] = {}
    covered, weight = np.zeros(len(sizes)), np.ones(len(sizes))
    least = (sizes * counts).sum() / capacity
    for step in range(STEPS):
        prices = sizes * weight
        value, item = _knapsack(sizes, prices, capacity)
        around = prices + value[capacity - sizes]
        # Shares of the step: lengths behind the others, in configurations worth nearly the best price.
        behind = np.maximum((step + 1) / STEPS - covered / counts, 0)
        behind[around < NEARLY * value[capacity]] = 0
        if not behind.any():
            behind = (around >= around.max()).astype(float)
        chosen = np.flatnonzero(behind)
        found = _fill(chosen, sizes, item, capacity)
        needed = behind[chosen] * counts[chosen]
        share = least / STEPS * needed / needed.sum()
        for configuration, more in zip(found, share.tolist(), strict=True):
            copies[configuration] = copies.get(configuration, 0.0) + more
            np.add.at(covered, list(configuration), more)
        rest = covered / counts
        weight = np.exp(-RATE * (rest - rest.min()) / max((step + 1) / STEPS, 1e-9))
    return copies


def _best_fit(left: np.ndarray, sizes: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(copies, items): the left pieces best fit, longest first, many equal ones at a time."""
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for at in np.argsort(-sizes, kind="stable").tolist():
        size, n = int(sizes[at]), int(left[at])
        for room in sorted(room for room in open_ if room >= size):
            while n and open_.get(room):
                copies, items = open_[room].pop()
                each = min(room // size, max(n // copies, 1))
                taken = min(copies, n // each)
                if taken < copies:
                    open_[room].append((copies - taken, items))
                open_.setdefault(room - each * size, []).append((taken, items + (at,) * each))
                n -= taken * each
            if not n:
                break
        if n:
            each = capacity // size
            if n >= each:
                open_.setdefault(capacity - each * size, []).append((n // each, (at,) * each))
            if n % each:
                open_.setdefault(capacity - n % each * size, []).append((1, (at,) * (n % each)))
    return [one for groups in open_.values() for one in groups]


def plan(lengths: list[int], counts: list[int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(copies, [(length, number)]) of all sequences that hold `counts` pieces of `lengths`."""
    order = np.argsort(lengths)
    sizes, left = np.array(lengths, dtype=np.int64)[order], np.array(counts, dtype=np.int64)[order]
    if not len(sizes):
        return []
    done: list[tuple[int, tuple[int, ...]]] = []
    copies = fractional_configurations(sizes, left.astype(float), capacity)
    filled = sorted(copies, key=lambda one: (-int(sizes[list(one)].sum()), -copies[one], one))
    for limit in (np.floor, np.ceil):
        for configuration in filled:
            items, each = np.unique(configuration, return_counts=True)
            taken = min(int(limit(copies[configuration])), int((left[items] // each).min()))
            if taken > 0:
                left[items] -= taken * each
                copies[configuration] -= taken
                done.append((taken, configuration))
    done += _best_fit(left, sizes, capacity)
    out = []
    for n, configuration in done:
        items, each = np.unique(configuration, return_counts=True)
        out.append((n, list(zip(sizes[items].tolist(), each.tolist(), strict=True))))
    return out


def places(sequences: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """Per length the stretches of its pieces: columns first piece, sequence, pieces per sequence, offset."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    dealt: dict[int, int] = {}
    base = 0
    for copies, content in sequences:
        offset = 0
        for length, each in content:
            found.setdefault(length, []).append((dealt.get(length, 0), base, each, offset))
            dealt[length] = dealt.get(length, 0) + copies * each
            offset += length * each
        base += copies
    return {length: np.array(rows, dtype=np.int64) for length, rows in found.items()}


# -- rows --------------------------------------------------------------------------------------


def _stretches(placed):
    """Which places each (block, length) fills: its pieces are number `base` and following of the length."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = placed.value
        for batch in batches:
            block, length, n, base = (column.to_numpy() for column in batch.columns)
            out = []
            for size, count, begin in zip(length.tolist(), n.tolist(), base.tolist(), strict=True):
                rows = table[size]
                low = int(np.searchsorted(rows[:, 0], begin, side="right")) - 1
                high = int(np.searchsorted(rows[:, 0], begin + count, side="left"))
                out.append(
                    [
                        {"nth": max(first - begin, 0), "first": max(begin - first, 0), "sequence": seq, "each": each, "offset": at}
                        for first, seq, each, at in rows[low:high].tolist()
                    ]
                )
            kind = pa.list_(
                pa.struct(
                    [("nth", pa.int64()), ("first", pa.int64()), ("sequence", pa.int64()), ("each", pa.int32()), ("offset", pa.int32())]
                )
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(length, pa.int32()), pa.array(out, kind)],
                names=["block", "length", "segments"],
            )

    return segments


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids, ids_crc32, block, nth) of every document, written once.

    `ids` are little-endian unsigned 32-bit numbers; `nth` counts the pieces of a length in a block.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = spark.sparkContext.broadcast(file.read())
    schema = _PIECES.format(id=docs.schema[id_col].dataType.simpleString())
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    path = scratch_path(spark, "token_pieces")
    cut = rows.mapInArrow(_cut_pieces(tokenizer_json, capacity, end_id), schema)
    cut.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of `token_pieces` with `sequence_id` and `offset`.

    Take only the columns needed: `ids` would travel along with the join.
    """
    spark = pieces.sparkSession
    counts = cut_lineage(pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    # At most `capacity` rows.
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    sequences = plan([row.length for row in histogram], [row.n for row in histogram], capacity)
    placed = spark.sparkContext.broadcast(places(sequences))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    based = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    stretches = based.select("block", "length", "n", "base").mapInArrow(_stretches(placed), _SEGMENTS)
    met = pieces.join(stretches, ["block", "length"])
    chosen = met.withColumn("at", F.element_at(F.filter("segments", lambda s: s["nth"] <= F.col("nth")), -1))
    rank = F.col("at.first") + F.col("nth") - F.col("at.nth")
    return chosen.select(
        "id",
        "piece",
        "start",
        "length",
        "ids",
        "ids_crc32",
        (F.col("at.sequence") + F.floor(rank / F.col("at.each"))).cast("long").alias("sequence_id"),
        (F.col("at.offset") + rank % F.col("at.each") * F.col("length")).cast("long").alias("offset"),
    )


def digest(packed: DataFrame) -> DataFrame:
    """Where each piece lies, and the CRC-32 of its ids."""
    return packed.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )
