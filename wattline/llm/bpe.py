"""Byte-level BPE encoding and decoding around one shuffle of distinct words.

A pass over the documents cuts texts into pre-tokens and numbers the distinct ones of a block (some
million characters of one task) by first use. Documents become lists of those numbers, in
text order; words go out once per block, dealt by hash. Where the copies of a word meet it is
encoded once, and its ids return to the blocks that have it. Every block then puts its documents
together by position. The numbered documents are a table bucketed by block, so they are not
shuffled: only distinct words and their ids are.

Decoding looks the ids up in the token-byte table, which has one row per rank whatever the
data's size and is broadcast.

Ids are little-endian unsigned 32-bit numbers in a binary column, as training shards hold them.

Cases: null and empty texts have no ids and decode to nothing; rows are encoded one by one,
repeated ids and texts too; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.batches import bound_batches
from wattline.session import scratch_path

#: Characters whose words share one numbering; bounds the memory of a task.
BLOCK_CHARS = 16_000_000
#: Up to this many bytes a scan for the best pair is quicker than a heap.
_SHORT = 48


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank by token bytes, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair with the lowest rank merges first, leftmost on ties."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = [word[at : at + 1] for at in range(len(word))]
    if len(word) > _SHORT:
        return [ranks[part] for part in _merged_by_heap(parts, ranks)]
    while len(parts) > 1:
        best, place = None, -1
        for at in range(len(parts) - 1):
            rank = ranks.get(parts[at] + parts[at + 1])
            if rank is not None and (best is None or rank < best):
                best, place = rank, at
        if best is None:
            break
        parts[place : place + 2] = [parts[place] + parts[place + 1]]
    return [ranks[part] for part in parts]


def _merged_by_heap(parts: list[bytes | None], ranks: dict[bytes, int]) -> list[bytes]:
    """The same order of merges for long words, in n log n steps."""
    after = [*range(1, len(parts)), -1]
    before = [*range(-1, len(parts) - 1)]
    heap: list[tuple[int, int, bytes, bytes]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] >= 0:
            left, right = parts[at], parts[after[at]]
            rank = ranks.get(left + right)
            if rank is not None:
                heapq.heappush(heap, (rank, at, left, right))

    for at in range(len(parts)):
        offer(at)
    while heap:
        _, at, left, right = heapq.heappop(heap)
        next_ = after[at]
        if parts[at] != left or next_ < 0 or parts[next_] != right:
            continue
        parts[at], parts[next_] = left + right, None
        after[at] = after[next_]
        if after[at] >= 0:
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return [part for part in parts if part is not None]


def _numbers_out(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Seven bits a byte, low ones first, the last byte below 128; and the length of each."""
    sizes = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21) + (values >= 1 << 28)
    wide = (values[:, None] >> np.arange(0, 35, 7)) & 127
    spot = np.arange(5)[None, :]
    wide = np.where(spot < sizes[:, None] - 1, wide | 128, wide).astype(np.uint8)
    return wide[spot < sizes[:, None]].tobytes(), sizes


def _numbers_in(data: np.ndarray) -> np.ndarray:
    """The numbers that `_numbers_out` wrote."""
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    sizes = ends - starts + 1
    values = np.zeros(len(ends), dtype=np.int64)
    for at in range(5):
        has = sizes > at
        values[has] |= (data[starts[has] + at].astype(np.int64) & 127) << (7 * at)
    return values


def _packed(data: bytes) -> bytes:
    return pa.compress(data, "zstd", asbytes=True) if data else b""


def _unpacked(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True) if size else b""


def _binaries(offsets: np.ndarray, data: bytes | np.ndarray) -> pa.Array:
    """Binary values that lie one after another in `data`."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


_BLOCK_SCHEMA = "id {id}, block long, numbers binary, part long, places binary, words binary, n_words long, n_bytes long"


def _number_words(pattern: str, parts: int, block_chars: int):
    """Rows of documents as word numbers, and per block and part a row of its distinct words."""

    def block_words(words: dict[str, int], block: int, id_type: pa.DataType) -> pa.RecordBatch:
        by_part: list[list[int]] = [[] for _ in range(parts)]
        encoded = [word.encode() for word in words]
        for at, word in enumerate(encoded):
            by_part[zlib.crc32(word) % parts].append(at)
        rows: dict[str, list] = {name: [] for name in ("part", "places", "words", "n_words", "n_bytes")}
        for part, places in enumerate(by_part):
            if places:
                own = [encoded[at] for at in places]
                steps, _ = _numbers_out(np.diff(np.array(places), prepend=0))
                sizes, _ = _numbers_out(np.array([len(word) for word in own]))
                joined = sizes + b"".join(own)
                for name, value in zip(rows, (part, steps, _packed(joined), len(own), len(joined)), strict=True):
                    rows[name].append(value)
        size = len(rows["part"])
        return pa.RecordBatch.from_arrays(
            [
                pa.nulls(size, id_type),
                pa.array([block] * size, pa.int64()),
                pa.nulls(size, pa.binary()),
                pa.array(rows["part"], pa.int64()),
                pa.array(rows["places"], pa.binary()),
                pa.array(rows["words"], pa.binary()),
                pa.array(rows["n_words"], pa.int64()),
                pa.array(rows["n_bytes"], pa.int64()),
            ],
            names=["id", "block", "numbers", "part", "places", "words", "n_words", "n_bytes"],
        )

    def document_rows(ids: pa.Array, numbered: list[list[int]], block: int) -> pa.RecordBatch:
        flat = np.fromiter((n for one in numbered for n in one), dtype=np.int64)
        data, sizes = _numbers_out(flat)
        tokens = np.concatenate([[0], np.cumsum([len(one) for one in numbered])]).astype(np.int64)
        size = len(numbered)
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([block] * size, pa.int64()),
                _binaries(np.concatenate([[0], np.cumsum(sizes)])[tokens], data),
                *[pa.nulls(size, kind) for kind in (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())],
            ],
            names=["id", "block", "numbers", "part", "places", "words", "n_words", "n_bytes"],
        )

    def numbered_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        first = TaskContext.get().partitionId() << 24
        blocks, words, held = count(first), defaultdict(count().__next__), 0
        block, id_type = next(blocks), None
        for batch in batches:
            id_type = batch.column(0).type
            texts = batch.column(1).to_pylist()
            start, numbered, size = 0, [], 0
            for at, text in enumerate(texts):
                numbered.append(list(map(words.__getitem__, find(text or ""))))
                size += len(text or "")
                full = held + size >= block_chars
                if full or size >= block_chars // 16 or at == len(texts) - 1:
                    yield document_rows(batch.column(0)[start : at + 1], numbered, block)
                    start, numbered, held, size = at + 1, [], held + size, 0
                if full:
                    yield block_words(words, block, id_type)
                    block, words, held = next(blocks), defaultdict(count().__next__), 0
        if words:
            yield block_words(words, block, id_type)

    return numbered_rows


def _encode_words(ranks):
    """Ids of each row's words, in their order; a word is encoded once per part."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, current, known = ranks.value, None, {}
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in ("block", "places", "sizes", "ids", "n_sizes", "n_ids")}
            for block, part, places, words, n_words, n_bytes in zip(
                *[column.to_pylist() for column in batch.columns], strict=True
            ):
                if part != current:
                    current, known = part, {}
                data = _unpacked(words, n_bytes)
                raw = np.frombuffer(data, dtype=np.uint8)
                # The sizes come first; as many numbers as there are words.
                head = int(np.flatnonzero(raw[: 5 * n_words] < 128)[n_words - 1]) + 1
                ends = (head + np.cumsum(_numbers_in(raw[:head]))).tolist()
                found, start = [], head
                for end in ends:
                    word = data[start:end]
                    start = end
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = merge(word, table)
                    found.append(ids)
                flat = np.fromiter((i for ids in found for i in ids), dtype=np.uint32)
                sizes, _ = _numbers_out(np.array([len(ids) for ids in found]))
                row = (block, places, _packed(sizes), _packed(flat.tobytes()), len(sizes), len(flat))
                for name, value in zip(rows, row, strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["block"], pa.int64()),
                    *[pa.array(rows[name], pa.binary()) for name in ("places", "sizes", "ids")],
                    pa.array(rows["n_sizes"], pa.int64()),
                    pa.array(rows["n_ids"], pa.int64()),
                ],
                names=["block", "places", "sizes", "ids", "n_sizes", "n_ids"],
            )

    return encoded


def _reassemble(documents: pa.Table, words: pa.Table) -> pa.Table:
    """The documents of one block with their ids in text order."""
    places, sizes, ids = [], [], []
    for row in words.to_pylist():
        places.append(np.cumsum(_numbers_in(np.frombuffer(row["places"], dtype=np.uint8))))
        sizes.append(_numbers_in(np.frombuffer(_unpacked(row["sizes"], row["n_sizes"]), dtype=np.uint8)))
        ids.append(np.frombuffer(_unpacked(row["ids"], 4 * row["n_ids"]), dtype=np.uint32))
    flat = np.concatenate(ids) if ids else np.array([], dtype=np.uint32)
    size = np.concatenate(sizes) if sizes else np.array([], dtype=np.int64)
    begin, length = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
    place = np.concatenate(places) if places else np.array([], dtype=np.int64)
    begin[place], length[place] = np.cumsum(size) - size, size
    out = []
    for batch in documents.select(["id", "numbers"]).to_batches(max_chunksize=512):
        raw = batch.column(1).to_pylist()
        numbers = _numbers_in(np.frombuffer(b"".join(raw), dtype=np.uint8))
        per_word = length[numbers]
        chosen = flat[_runs(begin[numbers], per_word)]
        tokens = np.array([int((np.frombuffer(one, dtype=np.uint8) < 128).sum()) for one in raw])
        ends = np.concatenate([[0], np.cumsum(per_word)])[np.concatenate([[0], np.cumsum(tokens)])]
        out.append(
            pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends), pa.int64()), _binaries(4 * ends, chosen)],
                names=["id", "n_tokens", "ids"],
            )
        )
    kind = documents.schema.field("id").type
    return pa.Table.from_batches(out, pa.schema([("id", kind), ("n_tokens", pa.int64()), ("ids", pa.binary())]))


_TABLES = "wattline_blocks_"


def drop_block_tables(spark: SparkSession) -> None:
    """Forget the bucketed tables of finished encodings; their files lie in the shared folder."""
    for table in spark.catalog.listTables():
        if table.name.startswith(_TABLES):
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def _bucketed(spark: SparkSession, rows: DataFrame, buckets: int) -> DataFrame:
    """`rows` as a table bucketed by block in the shared folder; it has to stay until the result is read."""
    name = f"{_TABLES}{uuid.uuid4().hex}"
    (
        rows.write.format("parquet")
        .option("path", scratch_path(spark, name))
        .option("compression", "zstd")
        .bucketBy(buckets, "block")
        .saveAsTable(name)
    )
    return spark.table(name)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Per row: id, n_tokens and ids (binary). Words are dealt out over `spark.sql.shuffle.partitions`."""
    spark = docs.sparkSession
    bound_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.mapInArrow(_number_words(pattern, parts, block_chars), _BLOCK_SCHEMA.format(id=kind))
    table = _bucketed(spark, rows, parts)
    words = table.filter("part IS NOT NULL").select("block", "part", "places", "words", "n_words", "n_bytes")
    encoded = (
        words.repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(_encode_words(ranks), "block long, places binary, sizes binary, ids binary, n_sizes long, n_ids long")
    )
    documents = table.filter("part IS NULL").select("id", "block", "numbers")
    return (
        documents.groupBy("block")
        .cogroup(encoded.groupBy("block"))
        .applyInArrow(_reassemble, f"id {kind}, n_tokens long, ids binary")
    )


def _decode(tokens):
    """Token bytes of the ids, one after another."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tokens.value
        data = np.frombuffer(b"".join(table), dtype=np.uint8)
        sizes = np.array([len(token) for token in table], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        for whole in batches:
            for start in range(0, len(whole), 512):
                batch = whole.slice(start, 512)
                raw = [ids or b"" for ids in batch.column(2).to_pylist()]
                ids = np.frombuffer(b"".join(raw), dtype="<u4").astype(np.int64)
                per_id = sizes[ids]
                borders = np.concatenate([[0], np.cumsum([len(one) // 4 for one in raw])]).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(per_id)])[borders]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, _binaries(ends, data[_runs(begin[ids], per_id)])],
                    names=["id", "n_tokens", "ids", "decoded"],
                )

    return decoded


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds `decoded`, the bytes of the ids, to rows (id, n_tokens, ids)."""
    bound_batches(encoded.sparkSession)
    by_rank = {rank: token for token, rank in read_ranks(ranks_path).items()}
    table = [by_rank.get(rank, b"") for rank in range(max(by_rank, default=-1) + 1)]
    tokens = encoded.sparkSession.sparkContext.broadcast(table)
    kind = encoded.schema["id"].dataType.simpleString()
    rows = encoded.select("id", "n_tokens", "ids")
    return rows.mapInArrow(_decode(tokens), f"id {kind}, n_tokens long, ids binary, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    """Per row: doc_id, n_tokens, SHA-256 of the ids and of the decoded bytes."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
