"""Filter interaction audit: what each of five filters removes under every order of applying them.

Four filters look at a document alone (A few words, B repeated words, C capitals, D symbols); E
fails a document whose text a smaller id has too. Copies are found by radix tries:

- A task inserts its texts into a compressed trie, block by block (`BLOCK_BYTES` of different
  texts). Terminals number the different texts and hold the smallest id, so of any number of
  copies one text per block goes on.
- Each block also says by which text prefixes it would cut itself into stretches of equal bytes,
  as short as they tell neighbours apart. The weighted quantiles of these prefixes are the borders
  of `spark.sql.shuffle.partitions` ranges.
- The texts move to their ranges and are inserted whole into tries again, in order, so that a
  trie can be traversed and dropped when it has grown to `BLOCK_BYTES`. Terminals of several
  blocks tell each block the smallest id, if it is not its own.
- Rows meet the smaller ids by (block, terminal), so no group of copies meets in one task.

Documents are then reduced to counts per (part, failed filters), at most 32 for each part,
and only these are spread over the 120 orders.

Cases: a null text is empty, a null language is the part ''; words are split at ASCII white space;
ids that are null come after all others and are never smaller than one another; rows repeating
both id and text are no copies of each other; a document with several labels counts as good or
toxic if any says so, labels of other ids are ignored; empty tables give empty results.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.batches import bound_batches
from wattline.session import cut_lineage

#: Bytes of different texts in a trie, and between two proposed borders.
BLOCK_BYTES, CUT_BYTES = 24_000_000, 500_000
#: The filters' letters; a document's failed ones are a string of them.
FILTERS = "ABCDE"

_ROWS = "id {id}, part string, fails string, block long, terminal int, least {id}, text binary, bytes long"
_NAMES = ["id", "part", "fails", "block", "terminal", "least", "text", "bytes"]
_SYMBOLS = b"#$%&*|"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes that continue a character in UTF-8.
_CONTINUED = bytes(range(0x80, 0xC0))


def own_failures(text: bytes) -> str:
    """The letters of the filters A to D that a text fails on its own."""
    words = text.split()
    fails = ""
    if len(words) < 100:
        fails += "A"
    if 100 * len(set(words)) < 80 * len(words):
        fails += "B"
    if 100 * (len(text) - len(text.translate(None, _CAPITALS))) > 10 * len(text.translate(None, _CONTINUED)):
        fails += "C"
    if len(text) > len(text.translate(None, _SYMBOLS)):
        fails += "D"
    return fails


class RadixTrie:
    """A compressed trie over whole texts: edges are stretches of inserted texts, terminals are numbered."""

    def __init__(self):
        #: Edges by first byte: [text, start, end, edges below or None, terminal or -1].
        self._edges: dict[int, list] = {}
        self._empty = -1
        self.texts: list[bytes] = []
        self.least: list = []
        self.bytes = 0

    def insert(self, text: bytes, key) -> int:
        """The terminal of a text; it keeps the smallest key that is not None."""
        terminal = self._place(text)
        held = self.least[terminal]
        if key is not None and (held is None or key < held):
            self.least[terminal] = key
        return terminal

    def _new(self, text: bytes) -> int:
        self.texts.append(text)
        self.least.append(None)
        self.bytes += len(text)
        return len(self.texts) - 1

    def _place(self, text: bytes) -> int:
        if not text:
            if self._empty < 0:
                self._empty = self._new(text)
            return self._empty
        edges, at, size = self._edges, 0, len(text)
        while True:
            edge = edges.get(text[at])
            if edge is None:
                terminal = self._new(text)
                edges[text[at]] = [text, at, size, None, terminal]
                return terminal
            held, start, end = edge[0], edge[1], edge[2]
            if text[at : at + end - start] == held[start:end]:
                at += end - start
                if at == size:
                    if edge[4] < 0:
                        edge[4] = self._new(text)
                    return edge[4]
                if edge[3] is None:
                    edge[3] = {}
                edges = edge[3]
                continue
            shared = _common(text, at, held, start, min(end - start, size - at))
            below = [held, start + shared, end, edge[3], edge[4]]
            edge[2], edge[3], edge[4] = start + shared, {held[start + shared]: below}, -1
            # The next step either ends here or adds a leaf beside `below`.

    def in_order(self) -> Iterator[tuple[int, int]]:
        """(terminal, bytes shared with the text before it) of all texts in byte order."""
        if self._empty >= 0:
            yield self._empty, 0
        # The smallest depth passed since the last text is where the two paths part.
        stack = [(edge, 0) for _, edge in sorted(self._edges.items(), reverse=True)]
        shared = 0
        while stack:
            edge, above = stack.pop()
            shared = min(shared, above)
            if edge[4] >= 0:
                yield edge[4], shared
                shared = edge[2]
            if edge[3]:
                stack += [(one, edge[2]) for _, one in sorted(edge[3].items(), reverse=True)]


def _common(a: bytes, at: int, b: bytes, start: int, size: int) -> int:
    """How many of the first `size` bytes from the two places agree; they do not all."""
    low, high = 0, size
    while low < high:
        middle = (low + high + 1) // 2
        if a[at + low : at + middle] == b[start + low : start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _cuts(trie: RadixTrie) -> list[tuple[bytes, int]]:
    """(prefix, bytes): borders of stretches of about `CUT_BYTES`; the prefix tells its text from the one before."""
    cuts, held, all_held = [], 0, max(trie.bytes, 1)
    step = min(CUT_BYTES, (all_held + 1) // 2)
    for terminal, shared in trie.in_order():
        if held >= step:
            cuts.append((trie.texts[terminal][: shared + 1], held))
            held = 0
        held += len(trie.texts[terminal])
    return cuts


def _batch(id_type: pa.DataType, block: int, columns: dict[str, list], n: int) -> pa.RecordBatch:
    none = [None] * n
    kinds = [id_type, pa.string(), pa.string(), pa.int64(), pa.int32(), id_type, pa.binary(), pa.int64()]
    columns = {"block": [block] * n, **columns}
    arrays = [pa.array(columns.get(name, none), kind) for name, kind in zip(_NAMES, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


class _Block:
    """A trie with the rows that led to its terminals."""

    def __init__(self, number: int, id_type: pa.DataType):
        self.number, self._id_type = number, id_type
        self.trie, self._fails = RadixTrie(), []
        self._ids, self._parts, self._terminals = [], [], []

    def add(self, key, part: str, text: bytes) -> None:
        terminal = self.trie.insert(text, key)
        if terminal == len(self._fails):
            self._fails.append(own_failures(text))
        self._ids.append(key)
        self._parts.append(part)
        self._terminals.append(terminal)

    def finished(self) -> Iterator[pa.RecordBatch]:
        """Its rows (with failures), its texts, and the borders it proposes (without terminals)."""
        trie, fails = self.trie, self._fails
        at = self._terminals
        yield self._out(
            len(at), id=self._ids, part=self._parts, fails=[fails[t] for t in at], terminal=at, least=[trie.least[t] for t in at]
        )
        for start in range(0, len(trie.texts), 500):
            texts = trie.texts[start : start + 500]
            numbers = list(range(start, start + len(texts)))
            yield self._out(len(texts), terminal=numbers, least=trie.least[start : start + 500], text=texts)
        cuts = _cuts(trie)
        yield self._out(len(cuts), text=[prefix for prefix, _ in cuts], bytes=[size for _, size in cuts])

    def _out(self, n: int, **columns: list) -> pa.RecordBatch:
        return _batch(self._id_type, self.number, columns, n)


def _insert_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a task through tries of `BLOCK_BYTES`."""
    number, block = TaskContext.get().partitionId() << 24, None
    for batch in batches:
        for key, part, text in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if block is None:
                block = _Block(number, batch.column(0).type)
            block.add(key, part, text)
            if block.trie.bytes >= BLOCK_BYTES:
                yield from block.finished()
                number, block = number + 1, None
    if block is not None:
        yield from block.finished()


def _borders(cuts: DataFrame, ranges: int) -> list[bytes]:
    """At most `ranges` - 1 prefixes, the weighted quantiles of all proposed borders."""
    placed = cut_lineage(
        cuts.repartitionByRange(ranges, "text")
        .sortWithinPartitions("text", "bytes", "block")
        .select("text", "bytes", F.spark_partition_id().alias("at"), F.monotonically_increasing_id().alias("nth")),
        "audit_cuts",
    )
    totals = {row["at"]: row["bytes"] for row in placed.groupBy("at").agg(F.sum("bytes").alias("bytes")).collect()}
    step = -(-sum(totals.values()) // ranges)
    before, passed = {}, 0
    for at in sorted(totals):
        before[at], passed = passed, passed + totals[at]
    if not passed:
        return []
    base = F.create_map([F.lit(one) for pair in before.items() for one in pair])[F.col("at")]
    upto = base + F.sum("bytes").over(Window.partitionBy("at").orderBy("nth"))
    counted = placed.withColumn("upto", upto)
    crossed = F.floor(F.col("upto") / step) > F.floor((F.col("upto") - F.col("bytes")) / step)
    return sorted({bytes(row.text) for row in counted.filter(crossed).select("text").collect()})


def _ranged(borders):
    """Adds the number of the range that each text lies in."""

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = borders.value
        for batch in batches:
            at = [bisect_right(prefixes, text) for text in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "at"])

    return ranged


def _smaller_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, terminal, least) where another block holds the text with a smaller id; texts come in order."""
    trie, came, last, id_type, names = RadixTrie(), {}, None, None, ["block", "terminal", "least"]

    def found() -> pa.RecordBatch:
        # Traverse the terminals; those that one block alone reached have nothing to tell.
        rows = [
            (block, number, trie.least[at])
            for at, _ in trie.in_order()
            if len(came[at]) > 1
            for block, number, own in came[at]
            if trie.least[at] is not None and own != trie.least[at]
        ]
        kinds = [pa.int64(), pa.int32(), id_type]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        id_type = batch.column(2).type
        for block, number, least, text in zip(*[column.to_pylist() for column in batch.columns[:4]], strict=True):
            # Equal texts are neighbours, so a full trie is complete as soon as another text comes.
            if trie.bytes >= BLOCK_BYTES and text != last:
                yield found()
                trie, came = RadixTrie(), {}
            at = trie.insert(text, least)
            came.setdefault(at, []).append((block, number, least))
            last = text
    if came:
        yield found()


def failed_filters(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """(id, part, fails): one row per document, `fails` the letters of the filters it fails, in order."""
    spark = docs.sparkSession
    bound_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        docs[f"`{id_col}`"].alias("id"),
        F.coalesce(docs[f"`{part_col}`"].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs[f"`{text_col}`"], F.lit("")).cast("binary").alias("text"),
    )
    tries = cut_lineage(rows.mapInArrow(_insert_rows, _ROWS.format(id=id_type)), "audit_tries")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = tries.filter("fails IS NULL AND terminal IS NOT NULL").select("block", "terminal", "least", "text")
    borders = spark.sparkContext.broadcast(_borders(tries.filter("terminal IS NULL"), ranges))
    smaller = (
        texts.mapInArrow(_ranged(borders), f"block long, terminal int, least {id_type}, text binary, at int")
        .repartitionById(ranges, F.col("at"))
        .sortWithinPartitions("text")
        .mapInArrow(_smaller_ids, f"block long, terminal int, least {id_type}")
    )
    own = tries.filter("fails IS NOT NULL").select("id", "part", "fails", "block", "terminal", "least")
    met = own.join(smaller.withColumnRenamed("least", "smaller"), ["block", "terminal"], "left")
    least = F.coalesce("smaller", "least")
    copied = F.when(F.col("id").isNull(), least.isNotNull()).otherwise(F.col("id") > least)
    return met.select("id", "part", F.concat("fails", F.when(copied, "E").otherwise(F.lit(""))).alias("fails"))


def _marks(labels: DataFrame, id_col: str) -> DataFrame:
    rows = labels.select(labels[f"`{id_col}`"].alias("id"), labels["`quality`"].alias("q"), labels["`toxic`"].alias("t"))
    return rows.groupBy("id").agg(
        F.max((F.col("q") == 1).cast("long")).alias("good"), F.max((F.col("t") == 1).cast("long")).alias("toxic")
    )


def _lacks(fails: Column, letters: Column) -> Column:
    """`fails` without the letters."""
    return F.regexp_replace(fails, F.concat(F.lit("["), letters, F.lit("]")), F.lit(""))


def audit(failed: DataFrame, labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """Per part, order of the filters and step: what the step keeps and removes, and its filter's worth."""
    marked = failed.join(_marks(labels, label_id), "id", "left")
    counts = marked.groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    spread = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(steps))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    begun = spread.withColumn("filter", letter).withColumn(
        "left", F.when(F.col("step") > 1, _lacks(F.col("fails"), F.substring("filter_order", F.lit(1), F.col("step") - 1))).otherwise(F.col("fails"))
    )
    failing, here = F.contains("fails", "filter"), F.col("left") == F.col("fails")
    removed = failing & here

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(F.lit(0)))

    stepped = begun.groupBy("part", "filter_order", "step", "filter").agg(
        total(here & ~failing).alias("kept"),
        total(removed).alias("removed"),
        total(failing & ~here).alias("redundant"),
        total(F.col("fails") == F.col("filter")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
    )
    over_orders = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return stepped.withColumn("shapley", over_orders).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
