"""N-gram Jaccard join under several global token orders, down to its components.

Documents with equal shingle sets form one class. Classes that link at a Jaccard similarity of
at least 90 % share, under *any* global order of shingles, one of the first n - ceil(0.9 n) + 1.
Three orders are used. Order 0 begins with a sixth of all shingles (at 80 % with a third), the
rarest of them first by the counts of a fixed-size sketch; the others are orders of two more hashes. Candidates share
a first token under order 0 and a size range; they go on only if the bits that one set's bitmap
has and the other lacks are few enough and if they share first tokens under orders 1 and 2 too.
What is left is verified on the full sets.

First tokens travel once, as (token, number of the class), sorted by token; tokens of one class
alone are dropped as they stream by. Only the classes that are left are read again: their bitmaps
(eight bits a shingle and more) and further first tokens are written by class, in buckets, so that
pairs come to them and they stay where they are. Texts of classes that meet a candidate are read
once more to compare the sets.

A large group of near copies is not paired off. First every member of a token's group is
compared with one hub only; groups that end up in one component are done. The others are put
together by their largest component, and the classes outside it meet all members in blocks,
each pair in one place whatever tokens it shares. Tasks compare blocks on bitmaps: first
each class sends on only its closest partners in other components, over all blocks, which
connects what still belongs together; then, in the last, all that bitmaps allow. So every link
between different components is tested, and components are exact.

A class is known by 128 bits of its set, in the exchange of tokens by 64 bits of these.

Cases: null texts, empty texts and texts without words have no shingles and link with nothing;
equal ids with different texts are separate documents; null ids count as largest; repeated rows
give the same result each; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import bound_batches
from wattline.llm.columns import row_key
from wattline.llm.shingles import chunks, mixed, shingle_lists
from wattline.session import cut_lineage, scratch_path

SHINGLE = 3
#: Similarity in percent: 100 * intersection >= SIMILAR * union.
SIMILAR = 90
#: The frequency sketch has 2 ** SKETCH_BITS counters whatever the data's size (one byte each)
#: and counts some of the shingles, about as many as first tokens need.
SKETCH_BITS = 24
_SKETCH_PIECES = 32
#: Bits per shingle in a set's bitmap, at least; its size is a power of two between these (bytes).
BITMAP_LOAD, BITMAP_BYTES = 8, (16, 8192)
#: Bits of the map that says which texts are wanted again (2 MB, whatever the data's size).
SLOT_BITS = 24
#: Members per block.
BLOCK = 256
#: Partners of a class that a round over the blocks tries, and such rounds; the last round tries all that are left.
CLOSEST, CLOSEST_ROUNDS = 3, 1
#: Rows of one token that a task holds back to look at them together; of a token with more, all go on.
HELD_ROWS = 2_000_000
_SALTS = np.array([0x0, 0xA24BAED4963EE407, 0x9FB21C651E98DF25], dtype=np.uint64)


def prefix_size(n: int, similar: int = SIMILAR) -> int:
    """How many of n first tokens a partner must share one of."""
    return n + (-similar * n) // 100 + 1


def _counted(found: np.ndarray, similar: int) -> np.ndarray:
    """Whether the sketch counts a shingle (one in six at 90 %); independent of its counter."""
    return found % np.uint64(1 << 20) % np.uint64(max(60 // max(100 - similar, 1), 1)) == 0


def _counter(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _sketch(shingle: int, similar: int):
    """Counters that a task has raised: one compressed row of (steps, counts) per piece."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.uint16)
        for batch in batches:
            for _, texts in chunks(batch.column(0).to_pylist()):
                found = np.concatenate([*shingle_lists(texts, shingle)])
                raised, times = np.unique(_counter(found[_counted(found, similar)]), return_counts=True)
                # What a task counts beyond 16 bits is frequent in any case.
                total[raised] = np.minimum(total[raised] + times, 65_535)
        rows: dict[str, list] = {"piece": [], "n": [], "counts": []}
        for piece, own in enumerate(np.split(total, _SKETCH_PIECES)):
            at = np.flatnonzero(own)
            packed = np.concatenate([np.diff(at, prepend=0), own[at]]).astype(np.int32)
            rows["piece"].append(piece)
            rows["n"].append(len(at))
            rows["counts"].append(pa.compress(packed.tobytes(), "zstd", asbytes=True) if len(at) else b"")
        yield pa.RecordBatch.from_pydict(rows)

    return count


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums pieces that arrive sorted by number and holds one at a time; small counts stay exact."""
    size = (1 << SKETCH_BITS) // _SKETCH_PIECES
    current, total = None, np.zeros(size, dtype=np.int64)

    def levels() -> pa.RecordBatch:
        steep = 64 + 4 * np.log2(np.maximum(total, 64) / 64)
        level = np.minimum(np.where(total < 64, total, steep), 254).astype(np.uint8)
        return pa.RecordBatch.from_pydict({"piece": [current], "levels": [level.tobytes()]})

    for batch in batches:
        for piece, n, counts in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if piece != current:
                if current is not None:
                    yield levels()
                current, total = piece, np.zeros(size, dtype=np.int64)
            if n:
                packed = np.frombuffer(pa.decompress(counts, 8 * n, "zstd", asbytes=True), dtype=np.int32)
                total[np.cumsum(packed[:n])] += packed[n:]
    if current is not None:
        yield levels()


def frequency_levels(texts: DataFrame, shingle: int = SHINGLE, similar: int = SIMILAR) -> bytes:
    """Levels of the sketch's counters over all texts: a fixed number of bytes."""
    counted = texts.mapInArrow(_sketch(shingle, similar), "piece long, n long, counts binary")
    summed = (
        counted.repartition(_SKETCH_PIECES, "piece")
        .sortWithinPartitions("piece")
        .mapInArrow(_add_up, "piece long, levels binary")
    )
    pieces = {row["piece"]: bytes(row["levels"]) for row in summed.collect()}
    blank = bytes((1 << SKETCH_BITS) // _SKETCH_PIECES)
    return b"".join(pieces.get(at, blank) for at in range(_SKETCH_PIECES))


def _first_tokens(keys: np.ndarray, count: int) -> np.ndarray:
    """The `count` smallest keys, and any that equal the last of them."""
    return keys[keys <= np.partition(keys, count - 1)[count - 1]]


def bitmap(found: np.ndarray) -> bytes:
    """A bit per shingle, by hash."""
    size = 8 * BITMAP_BYTES[0]
    while size < BITMAP_LOAD * len(found) and size < 8 * BITMAP_BYTES[1]:
        size *= 2
    bits = np.zeros(size, dtype=bool)
    bits[(found & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of bitmaps made as narrow as `width` bytes: a shingle's place is its hash modulo the size."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _missing(ours: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each row of `ours` (one row, or as many) that `theirs` lacks, and the other way round."""
    a, b = ours.view(np.uint64), theirs.view(np.uint64)
    return np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64), np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)


def class_of(found: np.ndarray) -> bytes:
    return hashlib.md5(found.tobytes()).digest()


def _summaries(shingle: int, similar: int, levels):
    """Per row: key of the text, class, its number, size, and, once per task and class, the first tokens of order 0."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = np.frombuffer(levels.value, dtype=np.uint8), set()
        for batch in batches:
            for first, texts in chunks(batch.column(2).to_pylist()):
                classes, sizes, tokens = [], [], []
                for repeated in shingle_lists(texts, shingle):
                    found = np.unique(repeated)
                    sizes.append(len(found))
                    classes.append(class_of(found) if len(found) else None)
                    if not len(found) or classes[-1] in seen:
                        tokens.append(None)
                        continue
                    seen.add(classes[-1])
                    rarity = np.where(_counted(found, similar), level[_counter(found)], 255).astype(np.uint64)
                    keys = rarity << np.uint64(56) | mixed(found ^ _SALTS[0]) >> np.uint64(8)
                    tokens.append(_first_tokens(keys, prefix_size(len(found), similar)).astype(np.int64))
                span = slice(first, first + len(texts))
                numbers = [None if one is None else int.from_bytes(one[:8], "little", signed=True) for one in classes]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[span],
                        batch.column(1)[span],
                        pa.array(classes, pa.binary()),
                        pa.array(numbers, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(tokens, pa.list_(pa.int64())),
                    ],
                    names=["id", "text_key", "class", "number", "n", "first0"],
                )

    return summarise


def _details(shingle: int, similar: int, wanted):
    """What pairs are tested on, of the texts whose slot is marked, once per task and class; rows are (slot, text)."""

    def details(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, seen = np.frombuffer(wanted.value, dtype=np.uint8), set()
        for batch in batches:
            slots = batch.column(0).to_numpy()
            chosen = batch.column(1).filter(pa.array((marks[slots >> 3] >> (slots & 7)) & 1 == 1))
            for _, texts in chunks(chosen.to_pylist()):
                rows: dict[str, list] = {name: [] for name in ("class", "n", "bits", "first1", "first2")}
                for repeated in shingle_lists(texts, shingle):
                    found = np.unique(repeated)
                    name = class_of(found)
                    if not len(found) or name in seen:
                        continue
                    seen.add(name)
                    first = [_first_tokens(mixed(found ^ salt), prefix_size(len(found), similar)) for salt in _SALTS[1:]]
                    # These orders only confirm: four bytes of a token will do.
                    first = [mixed(kept).astype(np.uint32).astype(np.int32) for kept in first]
                    for column, value in zip(rows.values(), (name, len(found), bitmap(found), *first), strict=True):
                        column.append(value)
                kinds = [pa.binary(), pa.int64(), pa.binary(), *[pa.list_(pa.int32())] * 2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(rows.values(), kinds, strict=True)], names=list(rows)
                )

    return details


def _packed_texts(shingle: int, wanted):
    """(class, packed, size) of the texts whose slot is marked, once per task and class; rows are (slot, text)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, seen = np.frombuffer(wanted.value, dtype=np.uint8), set()
        for batch in batches:
            slots = batch.column(0).to_numpy()
            chosen = batch.column(1).filter(pa.array((marks[slots >> 3] >> (slots & 7)) & 1 == 1))
            for _, texts in chunks(chosen.to_pylist()):
                out = []
                for text, repeated in zip(texts, shingle_lists(texts, shingle), strict=True):
                    name = class_of(np.unique(repeated))
                    if name not in seen:
                        seen.add(name)
                        out.append((name, pa.compress(text, "zstd", asbytes=True), len(text)))
                columns = list(zip(*out, strict=True)) if out else [(), (), ()]
                kinds = (pa.binary(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["class", "packed", "size"]
                )

    return packed


def _most_missing(n_a: np.ndarray, n_b: np.ndarray, similar: int) -> tuple[np.ndarray, np.ndarray]:
    """How many shingles of a may be missing in b at most, and of b in a."""
    needed = -(-similar * (n_a + n_b) // (100 + similar))
    return n_a - needed, n_b - needed


def _fitting_bitmaps(similar: int):
    """Keeps the pairs (a, b, n_a, n_b, bits_a, bits_b) whose sizes and bitmaps allow a link."""

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(at).to_numpy() for at in (2, 3))
            most_a, most_b = _most_missing(n_a, n_b, similar)
            keep = (most_a >= 0) & (most_b >= 0)
            sides = [batch.column(at).to_pylist() for at in (4, 5)]
            widths = np.array([[len(a), len(b)] for a, b in zip(*sides, strict=True)]).reshape(-1, 2)
            for width_a, width_b in {tuple(one) for one in widths.tolist()}:
                rows = np.flatnonzero(keep & (widths[:, 0] == width_a) & (widths[:, 1] == width_b))
                a, b = (
                    _folded(np.frombuffer(b"".join([side[at] for at in rows]), dtype=np.uint8).reshape(-1, width), min(width_a, width_b))
                    for side, width in zip(sides, (width_a, width_b), strict=True)
                )
                lack_b, lack_a = _missing(a, b)
                keep[rows] = (lack_b <= most_a[rows]) & (lack_a <= most_b[rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column(at).filter(pa.array(keep)) for at in (0, 1)], names=["a", "b"]
            )

    return filtered


def _verified(shingle: int, similar: int):
    """Keeps the pairs (a, b, packed_a, size_a, packed_b, size_b) whose full sets are similar."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            packed_a, size_a, packed_b, size_b = (batch.column(at).to_pylist() for at in (2, 3, 4, 5))
            for at in range(len(batch)):
                texts = [pa.decompress(packed_a[at], size_a[at], "zstd", asbytes=True), pa.decompress(packed_b[at], size_b[at], "zstd", asbytes=True)]
                a, b = (np.unique(repeated) for text in texts for repeated in shingle_lists([text], shingle))
                both = np.sort(np.concatenate([a, b]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= similar * (len(a) + len(b) - common))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(at).filter(chosen) for at in (0, 1)], names=["a", "b"])

    return verify


def _block_survivors(similar: int, closest: int | None):
    """Pairs of one block pair that sizes and bitmaps allow; rows come sorted by block pair.

    `class` is in the outer block, `apart` says how many bits tell the two apart. With `closest`, of
    each outer class only so many pairs, those with most in common.
    """

    def compare(rows: list[tuple]) -> list[tuple[bytes, bytes, int]]:
        left, right = [r for r in rows if r[3]], [r for r in rows if not r[3]]
        by_width: dict[int, list[tuple]] = {}
        for row in right:
            by_width.setdefault(len(row[6]), []).append(row)
        out = []
        sides = []
        for width, members in by_width.items():
            bits = np.frombuffer(b"".join(r[6] for r in members), dtype=np.uint8).reshape(-1, width)
            sides.append((members, np.array([r[5] for r in members]), np.array([hash(r[7]) for r in members]), {width: bits}))
        for row in left:
            found: list[tuple[int, bytes]] = []
            own = np.frombuffer(row[6], dtype=np.uint8).reshape(1, -1)
            for members, sizes, comps, folded in sides:
                most_a, most_b = _most_missing(np.int64(row[5]), sizes, similar)
                fits = np.flatnonzero((most_a >= 0) & (most_b >= 0) & (comps != hash(row[7])))
                if not len(fits):
                    continue
                width = min(own.shape[1], max(folded))
                if width not in folded:
                    folded[width] = _folded(folded[max(folded)], width)
                lack_b, lack_a = _missing(_folded(own, width), folded[width][fits])
                passed = np.flatnonzero((lack_b <= most_a[fits]) & (lack_a <= most_b[fits]))
                found += [(int(lack_a[at] + lack_b[at]), members[fits[at]][4]) for at in passed]
            if closest is not None and len(found) > closest:
                found = sorted(found)[:closest]
            out += [(row[4], other, apart) for apart, other in found]
        return out

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("class", pa.binary()), ("other", pa.binary()), ("apart", pa.int64())])

        def pairs(found: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if held and held[-1][:3] != row[:3]:
                    yield pairs(compare(held))
                    held = []
                held.append(row)
        yield pairs(compare(held))

    return survivors


def components(links: DataFrame, name: str, comps: DataFrame | None = None) -> DataFrame:
    """(class, comp) of every class that has a link; comp is the smallest class reachable.

    Labels fall to the least label around and then to that label's own label, until none
    changes; the state is a written table, and one flag per step comes to the driver. Each class
    meets its own label and those around in one aggregate, so a step shuffles once when labels are
    broadcast. With `comps`, the components of earlier links, only these are linked with each other.
    """
    if comps is not None:
        return _merged(links, name, comps)
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = cut_lineage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp")), f"{name}_labels")
    while True:
        around = both.join(labels.select(F.col("a").alias("b"), F.col("comp").alias("near")), "b").select("a", "near")
        own = labels.select("a", F.col("comp").alias("near"), "comp")
        lower = (
            own.unionByName(around, allowMissingColumns=True)
            .groupBy("a")
            .agg(F.min("near").alias("low"), F.max("comp").alias("comp"))
        )
        jump = labels.select(F.col("a").alias("low"), F.col("comp").alias("next"))
        moved = lower.join(jump, "low", "left").select("a", F.coalesce("next", "low").alias("new"), "comp")
        moved = cut_lineage(moved, f"{name}_labels")
        labels = moved.select("a", F.col("new").alias("comp"))
        if moved.filter(F.col("new") != F.col("comp")).isEmpty():
            return labels.select(F.col("a").alias("class"), "comp")


def _merged(links: DataFrame, name: str, comps: DataFrame) -> DataFrame:
    """`components` of earlier links (`comps`) and further ones together."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        label = comps.select(F.col("class").alias(end), F.col("comp").alias(f"_{end}"))
        ends = ends.join(label, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    between = cut_lineage(
        ends.select(F.col("_a").alias("a"), F.col("_b").alias("b")).filter(F.col("a") != F.col("b")), f"{name}_between"
    )
    if between.isEmpty():
        return comps
    met = components(between, name)
    known = comps.join(met.select(F.col("class").alias("comp"), F.col("comp").alias("least")), "comp", "left")
    # Classes that had no link are ends of the new ones under their own name.
    alone = met.join(comps.select("class"), "class", "left_anti")
    return cut_lineage(
        known.select("class", F.coalesce("least", "comp").alias("comp")).unionByName(alone.select("class", "comp")),
        f"{name}_merged",
    )


def _grouped(groups: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Token rows with the present component of their class (its own class if it has no link)."""
    if comps is None:
        return groups.withColumn("comp", F.col("class"))
    return (
        groups.join(comps, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    )


def _open_families(rows: DataFrame) -> DataFrame:
    """(main, class, comp): members of all groups that span several components, by the largest of these."""
    by_comp = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_ = (
        by_comp.groupBy("token")
        .agg(F.max(F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"))
        .filter("comps > 1")
        .select("token", F.col("main.comp").alias("main"))
    )
    return rows.join(open_, "token").select("main", "class", "comp").distinct()


def _hub_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): each member with its group's hub, where they are in different components."""
    dice = F.xxhash64("class")
    hubs = rows.groupBy("token").agg(
        F.min(F.struct(dice.alias("dice"), "class", "comp")).alias("hub"),
        F.min("comp").alias("low"),
        F.max("comp").alias("high"),
    )
    open_ = hubs.filter(F.col("low") != F.col("high")).select(
        "token", F.col("hub.class").alias("hub"), F.col("hub.comp").alias("hub_comp")
    )
    return (
        rows.join(open_, "token")
        .filter(F.col("comp") != F.col("hub_comp"))
        .select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b"))
        .distinct()
    )


def _block_pairs(rows: DataFrame, summaries: DataFrame, similar: int, closest: int | None) -> DataFrame:
    """(a, b): pairs across components that bitmaps allow, found block against block.

    A family is cut into blocks by a hash of the class, so that a pair has one place in it. The
    classes outside the main component go to the blocks of all, and all to the blocks of those.
    """
    members = cut_lineage(_open_families(rows), "open_families")
    outside = F.col("comp") != F.col("main")
    sizes = members.groupBy("main").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if(outside) / BLOCK).cast("int").alias("out_blocks"),
    )
    # A written table, so that a large family can be split over tasks in the join with it.
    sizes = cut_lineage(sizes, "family_sizes")
    placed = members.join(sizes, "main").join(summaries, "class").withColumn("dice", F.xxhash64("class"))
    columns = ["main", "out_block", "block", "outer", "class", "n", "bits", "comp"]
    inner = placed.withColumns(
        {
            "block": F.pmod("dice", "blocks").cast("int"),
            "outer": F.lit(False),
            "out_block": F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)),
        }
    )
    outer = placed.filter(outside).withColumns(
        {
            "out_block": F.pmod(F.xxhash64("dice"), "out_blocks").cast("int"),
            "outer": F.lit(True),
            "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)),
        }
    )
    met = inner.select(*columns).unionByName(outer.select(*columns))
    found = (
        met.repartition("main", "out_block", "block")
        .sortWithinPartitions("main", "out_block", "block")
        .mapInArrow(_block_survivors(similar, closest), "class binary, other binary, apart long")
    )
    if closest is not None:
        # The closest of all blocks: at most `closest` of each block come here.
        nearest = F.slice(F.array_sort(F.collect_set(F.struct("apart", "other"))), 1, closest)
        found = found.groupBy("class").agg(nearest.alias("near")).select("class", F.inline("near"))
    return found.select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct()


def _candidates(pairs: DataFrame, near: DataFrame, similar: int) -> DataFrame:
    """The pairs that sizes and bitmaps allow and that share first tokens under orders 1 and 2."""

    def with_sides(some: DataFrame, columns: list[str]) -> DataFrame:
        for name in ("a", "b"):
            side = near.select(F.col("class").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])
            some = some.join(side, name)
        return some.select("a", "b", *[f"{c}_{name}" for c in columns for name in ("a", "b")])

    fitting = with_sides(pairs, ["n", "bits"]).mapInArrow(_fitting_bitmaps(similar), "a binary, b binary")
    ordered = with_sides(cut_lineage(fitting, "fitting_pairs"), ["first1", "first2"])
    shared = F.arrays_overlap("first1_a", "first1_b") & F.arrays_overlap("first2_a", "first2_b")
    return cut_lineage(ordered.filter(shared).select("a", "b"), "candidates")


def _slot(text_key: Column) -> Column:
    return F.pmod(F.xxhash64(text_key), F.lit(1 << SLOT_BITS))


def _marked_slots(text_keys: DataFrame) -> bytes:
    """A bit per slot that some key has: a fixed number of bytes, gathered by bitmap aggregates."""
    place = _slot(F.col("text_key")) + 1
    size = 4096
    pieces = (
        text_keys.groupBy(F.bitmap_bucket_number(place).alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    marks = bytearray((1 << SLOT_BITS) // 8)
    for row in pieces:
        marks[(row["piece"] - 1) * size : row["piece"] * size] = row["bits"]
    return bytes(marks)


class _Texts:
    """Texts of the classes that met a candidate, packed, read again when first needed.

    Which texts to read is told by a map of fixed size, so no text is shuffled but these. A few
    others share a slot; they are left out by class.
    """

    def __init__(self, texts: DataFrame, keys: DataFrame, shingle: int) -> None:
        self.slotted = texts.select(_slot(F.col("text_key")).alias("slot"), "text")
        self.keys, self.shingle = keys, shingle
        self.held: DataFrame | None = None

    def of(self, candidates: DataFrame) -> DataFrame | None:
        needed = candidates.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        if self.held is not None:
            needed = needed.join(self.held.select("class"), "class", "left_anti")
        keys = cut_lineage(self.keys.select("class", "text_key").join(needed, "class", "left_semi"), "needed_texts")
        if not keys.isEmpty():
            wanted = self.slotted.sparkSession.sparkContext.broadcast(_marked_slots(keys))
            read = self.slotted.mapInArrow(_packed_texts(self.shingle, wanted), "class binary, packed binary, size long")
            named = read.join(keys.select("class"), "class", "left_semi")
            new = cut_lineage(named.groupBy("class").agg(F.first("packed").alias("packed"), F.first("size").alias("size")), "packed_texts")
            self.held = new if self.held is None else self.held.unionByName(new)
        return self.held


def _links(candidates: DataFrame, texts: _Texts, similar: int) -> DataFrame:
    """The candidates whose full sets are similar."""
    held = texts.of(candidates)
    if held is None:
        return candidates
    for name in ("a", "b"):
        side = held.select(F.col("class").alias(name), F.col("packed").alias(f"packed_{name}"), F.col("size").alias(f"size_{name}"))
        candidates = candidates.join(side, name)
    full = candidates.select("a", "b", "packed_a", "size_a", "packed_b", "size_b")
    return cut_lineage(full.mapInArrow(_verified(texts.shingle, similar), "a binary, b binary"), "links")


def _shared_by_several(similar: int):
    """(token, number) of tokens that several classes of like size have; rows come sorted by token and number.

    A token then stands for a shingle and one of the two size ranges of a class; classes of
    linkable size have a range in common.
    """
    # A range is a hair wider than the ratio of linkable sizes, so these are never two ranges apart.
    wide = float(np.log(100 / similar)) * (1 + 1e-9)

    def ranged(token: np.ndarray, number: np.ndarray, n: np.ndarray, all_of: int | None) -> pa.RecordBatch:
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (number[1:] != number[:-1])
        token, number, n = token[new], number[new], n[new]
        place = np.floor(np.log(n) / wide).astype(np.int64)
        certain = np.zeros(len(token), dtype=bool) if all_of is None else token == all_of
        keys = [mixed(mixed(token.astype(np.uint64)) + (place + at).astype(np.uint64)) for at in (0, 1)]
        keys, numbers = np.concatenate(keys), np.concatenate([number, number])
        _, inverse, members = np.unique(keys, return_inverse=True, return_counts=True)
        kept = (members[inverse] > 1) | np.concatenate([certain, certain])
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[kept].astype(np.int64)), pa.array(numbers[kept])], names=["token", "number"]
        )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = None, None
        for batch in batches:
            if not len(batch):
                continue
            columns = [column.to_numpy() for column in batch.columns]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            token = columns[0]
            # The last token may go on in the next batch.
            border = int(np.searchsorted(token, token[-1], side="left")) if len(token) < HELD_ROWS else len(token)
            yield ranged(*[c[:border] for c in columns], hot if border < len(token) else int(token[-1]))
            hot = hot if border < len(token) else int(token[-1])
            held = [c[border:] for c in columns]
        if held is not None and len(held[0]):
            yield ranged(*held, hot)

    return shared


_NEAR = "class binary, n long, bits binary, first1 array<int>, first2 array<int>"
_TABLES = "wattline_near_"


def _by_class(near: DataFrame) -> DataFrame:
    """One row of each class of `near` (they are alike), in buckets of the class, in the shared folder.

    Joins on the class leave the table where it is, and rows travel once: a class has one row a task at most.
    """
    spark, name = near.sparkSession, f"{_TABLES}{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    alike = [c for c in near.columns if c != "class"]
    (
        near.repartition(buckets, "class")
        .groupBy("class")
        .agg(*[F.first(c).alias(c) for c in alike])
        .write.format("parquet")
        .option("path", scratch_path(spark, name))
        .bucketBy(buckets, "class")
        .sortBy("class")
        .saveAsTable(name)
    )
    return spark.table(name)


def _prepared(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, similar: int
) -> tuple[DataFrame, DataFrame, DataFrame, _Texts]:
    """Summary per row, (token, class) of shared first tokens, what pairs of their classes are tested on, and their texts."""
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(
        F.col(id_col).alias("id"),
        row_key(F.col(text_col)).alias("text_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    levels = spark.sparkContext.broadcast(frequency_levels(texts.select("text"), shingle, similar))
    kind = docs.schema[id_col].dataType.simpleString()
    summary = cut_lineage(
        texts.mapInArrow(
            _summaries(shingle, similar, levels),
            f"id {kind}, text_key binary, class binary, number long, n long, first0 array<long>",
        ),
        "summaries",
    )
    tokens = summary.select(F.explode("first0").alias("token"), "number", "n")
    numbered = cut_lineage(
        tokens.repartition("token")
        .sortWithinPartitions("token", "number")
        .mapInArrow(_shared_by_several(similar), "token long, number long"),
        "token_numbers",
    )
    involved = numbered.select("number").distinct()
    # Copies are one row before they meet the join: a class of a third of all rows is no hot spot.
    keys = cut_lineage(
        summary.filter("n > 0")
        .groupBy("class")
        .agg(F.min("number").alias("number"), F.min("text_key").alias("text_key"))
        .join(involved, "number", "left_semi"),
        "near_keys",
    )
    wanted = spark.sparkContext.broadcast(_marked_slots(keys))
    # Which texts to read again is told by a map of fixed size, so no text is shuffled. A few others
    # share a slot; they are left out by class.
    read = texts.select(_slot(F.col("text_key")).alias("slot"), F.col("text")).mapInArrow(_details(shingle, similar, wanted), _NEAR)
    near = _by_class(read.join(keys.select("class"), "class", "left_semi"))
    groups = cut_lineage(numbered.join(keys.select("number", "class"), "number").select("token", "class"), "token_groups")
    return summary.select("id", "text_key", "class", "n"), groups, near, _Texts(texts, keys, shingle)


def _classes(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, similar: int
) -> tuple[DataFrame, DataFrame | None]:
    """(id, text_key, class, n) per row, and (class, comp) of the classes with links."""
    members, groups, near, texts = _prepared(docs, id_col, text_col, shingle, similar)
    summaries = near.select("class", "n", "bits")

    def linked(pairs: DataFrame) -> DataFrame:
        return _links(_candidates(cut_lineage(pairs, "pairs"), near, similar), texts, similar)

    links = linked(_hub_pairs(_grouped(groups, None)))
    # The only pair of a group of two has met now.
    large = groups.groupBy("token").agg(F.count(F.lit(1)).alias("members")).filter("members > 2")
    groups = cut_lineage(groups.join(large.select("token"), "token", "left_semi"), "large_groups")
    # Whole components: pairs inside of one, as many as the square of a large group, are not looked at.
    comps = components(links, "hubs")
    for round_ in range(CLOSEST_ROUNDS):
        found = linked(_block_pairs(_grouped(groups, comps), summaries, similar, CLOSEST))
        comps = components(found, f"closest_{round_}", comps)
    found = linked(_block_pairs(_grouped(groups, comps), summaries, similar, None))
    return members, components(found, "all", comps)


def similar_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similar: int = SIMILAR,
) -> tuple[DataFrame, DataFrame]:
    """(members, links): every link between different shingle sets, also inside a component.

    `members` has per row doc_id, text_key, class, n_shingles and n_links (links of its class;
    documents of one class have equal sets), `links` the class pairs (a, b) with a < b. No class
    counts as connected yet, so the blocks test each pair of a family: members and tests grow
    with the square of a large group of near copies, as the links themselves do.
    """
    rows, groups, near, texts = _prepared(docs, id_col, text_col, shingle, similar)
    pairs = _block_pairs(_grouped(groups, None), near.select("class", "n", "bits"), similar, None)
    links = _links(_candidates(cut_lineage(pairs, "pairs"), near, similar), texts, similar)
    degrees = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n_links"))
    members = rows.join(degrees, "class", "left").select(
        F.col("id").alias("doc_id"),
        "text_key",
        "class",
        F.col("n").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    return members, links


def _named(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(class, first): the smallest (no id, id, text_key) of each class's component."""
    least = rows.filter("n > 0").groupBy("class").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("first")
    )
    if comps is None:
        return least
    together = least.join(comps, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    together = cut_lineage(together, "components")
    return together.join(
        together.groupBy("comp").agg(F.min("first").alias("least")), "comp"
    ).select("class", F.col("least").alias("first"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similar: int = SIMILAR,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links), `kept`.

    `kept` is true for one document of each component: rows with the smallest id (and, among
    equal ids, the smallest text key).
    """
    rows, comps = _classes(docs, id_col, text_col, shingle, similar)
    named = cut_lineage(_named(rows, comps), "component_ids")
    return rows.join(named, "class", "left").select(
        F.col("id").alias("doc_id"),
        "text_key",
        F.col("n").alias("n_shingles"),
        F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        (
            F.col("first").isNull()
            | (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key")))
        ).alias("kept"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similar: int = SIMILAR
) -> DataFrame:
    """The rows of `docs`, all columns, that stay when one document of each component does.

    Rows that repeat both id and text are one document, of which one row stays.
    """
    judged = near_duplicates(docs, id_col, text_col, shingle, similar).filter("NOT kept")
    gone = cut_lineage(judged.select(row_key(F.col("doc_id"), F.col("text_key")).alias("key")).distinct(), "dropped_rows")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    marked = rows.withColumn("key", row_key(F.col("row")[id_col], row_key(F.col("row")[text_col])))
    return marked.join(gone, "key", "left_anti").dropDuplicates(["key"]).select("row.*")
