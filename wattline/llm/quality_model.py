"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Document statistics are native columns. They are standardised and mapped to cosines with
fixed random frequencies, whose inner products approximate a Gaussian kernel. Every task sums
its share of the normal equations; Spark adds those up entry by entry, and the driver solves
one small system. Scores of labelled rows that the fit did not use are averaged in bins and
made monotone (pool adjacent violators), which turns scores into probabilities.

The fit reads a bounded sample: `FIT_ROWS` expected labelled rows, picked by a hash.

Cases: null and empty texts have zero statistics and a score like any other; labels other
than 0 and 1 are left out, a document with several labels counts with each; without usable
labels every score is 0.5; repeated rows are scored row by row; empty tables give empty
results; other columns are ignored, id and label columns are named by parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.columns import SPACE, count_of, word_list
from wattline.llm.language import held_out
from wattline.session import cut_lineage

FEATURES = 128
#: Width of the kernel in standard deviations of the statistics (all together).
WIDTH = 3.0
RIDGE = 1.0
SEED = 20_240
FIT_ROWS = 200_000
#: Tasks that sum the normal equations, and score bins of the calibration.
FIT_TASKS = 16
BINS = 200
CUT = 0.7


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and `stats`, an array of doubles computed from the text alone."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), word_list(text, SPACE).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.regexp_like(line, F.lit(r"\S")))
    wide = base.select(
        "doc_id",
        "text",
        lines.alias("lines"),
        F.greatest(F.size("words"), F.lit(1)).cast("double").alias("n"),
        F.size(F.array_distinct("words")).cast("double").alias("kinds"),
        # Neighbours that are equal, as in text that repeats a word.
        F.size(
            F.filter(
                F.zip_with("words", F.slice("words", 2, 2_000_000_000), lambda a, b: a == b),
                lambda same: same,
            )
        ).cast("double").alias("twins"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("double").alias("chars"),
    )
    chars, n, lines_n = F.greatest("chars", F.lit(1.0)), F.col("n"), F.greatest(F.size("lines"), F.lit(1))

    def share(characters: str) -> Column:
        return count_of(F.col("text"), characters) / chars

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    stats = [
        F.log1p("chars"),
        F.log1p("n"),
        F.col("chars") / n,
        F.col("kinds") / n,
        F.col("twins") / n,
        share("#*$%&"),
        share("|<>"),
        share("!?"),
        share(".,;:"),
        share("0123456789"),
        share(upper),
        share(lower),
        F.size("lines") / n,
        F.size(F.array_distinct("lines")) / lines_n,
    ]
    return wide.select("doc_id", F.array(*[s.cast("double") for s in stats]).alias("stats"))


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score: a few thousand numbers."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    borders: np.ndarray
    levels: np.ndarray

    def mapped(self, stats: np.ndarray) -> np.ndarray:
        angles = ((stats - self.mean) / self.scale) @ self.frequencies + self.phases
        cosines = np.cos(angles) * np.sqrt(2.0 / self.frequencies.shape[1])
        return np.hstack([cosines, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.mapped(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.levels):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), self.borders, self.levels), 0.0, 1.0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _normal_sums(model: Model, width: int):
    """Each task's X'X and X'y as one row of numbers."""
    size = len(model.phases) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            x = model.mapped(_matrix(batch.column(0), width))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            total += x.T @ np.column_stack([x, y])
        yield pa.RecordBatch.from_pydict({"sums": [total.ravel()]}, schema=pa.schema([("sums", pa.list_(pa.float64()))]))

    return sums


def _raw_scores(model: Model, width: int):
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0), width))
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column(1)], names=["raw", "label"])

    return scores


def pooled(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Non-decreasing least-squares fit by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            last, before = blocks.pop(), blocks.pop()
            weight = last[1] + before[1]
            blocks.append([(last[0] * last[1] + before[0] * before[1]) / weight, weight, last[2] + before[2]])
    return np.concatenate([[block[0]] * int(block[2]) for block in blocks]) if blocks else np.array([])


def fit(labelled: DataFrame) -> Model:
    """A model from rows (stats, label, part): `part` in 0..15, a hash; parts 12 to 15 calibrate."""
    used = labelled.select("stats", F.col("label").cast("double").alias("label"), "part")
    first = used.select(F.size("stats").alias("width")).first()
    if first is None:
        nothing = np.array([])
        return Model(nothing, nothing, np.zeros((0, 0)), nothing, nothing, nothing, nothing)
    width = first["width"]
    each = [F.element_at("stats", at + 1) for at in range(width)]
    moments = used.agg(*[F.avg(s) for s in each], *[F.stddev_pop(s) for s in each]).first()
    mean, scale = np.array(moments[:width], dtype=float), np.array(moments[width:], dtype=float)
    random = np.random.default_rng(SEED)
    model = Model(
        mean,
        np.where(scale > 1e-12, scale, 1.0),
        random.normal(scale=1.0 / WIDTH, size=(width, FEATURES)),
        random.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1),
        np.array([]),
        np.array([]),
    )
    fitted = used.filter("part < 12").select("stats", "label", "part").repartition(FIT_TASKS, "part")
    entries = (
        fitted.select("stats", "label")
        .mapInArrow(_normal_sums(model, width), "sums array<double>")
        .select(F.posexplode("sums").alias("at", "value"))
        .groupBy("at")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    total = np.zeros((FEATURES + 1) * (FEATURES + 2))
    for row in entries:
        total[row["at"]] = row["value"]
    sums = total.reshape(FEATURES + 1, FEATURES + 2)
    ridge = RIDGE * np.eye(FEATURES + 1)
    ridge[-1, -1] = 1e-9
    weights = np.linalg.solve(sums[:, :-1] + ridge, sums[:, -1])
    model = Model(model.mean, model.scale, model.frequencies, model.phases, weights, model.borders, model.levels)
    raw = used.filter("part >= 12").select("stats", "label").mapInArrow(_raw_scores(model, width), "raw double, label double")
    binned = (
        raw.withColumn("bin", F.floor(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) * BINS))
        .groupBy("bin")
        .agg(F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count(F.lit(1)).alias("n"))
        .orderBy("raw")
        .collect()
    )
    if not binned:
        return Model(model.mean, model.scale, model.frequencies, model.phases, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    levels = pooled(np.array([b["label"] for b in binned]), np.array([b["n"] for b in binned], dtype=float))
    borders = np.array([b["raw"] for b in binned])
    return Model(model.mean, model.scale, model.frequencies, model.phases, weights, borders, levels)


def _scored(model: Model, cut: float):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = len(model.mean)
            stats = _matrix(batch.column(2), width) if width else np.zeros((len(batch), 0))
            score = model.score(stats)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= cut).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return scored


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    cut: float = CUT,
) -> DataFrame:
    """Per row: doc_id, held_out, score (likelihood of label 1) and predicted; learns outside the fold."""
    kind = docs.schema[id_col].dataType.simpleString()
    stats = statistics(docs, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))
    stats = cut_lineage(stats, "document_stats")
    known = labels.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).alias("label")).filter("label IN (0, 1)")
    dice = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 32) - 1)) / float(1 << 32)
    share = min(1.0, fit_rows / max(known.count(), 1))
    learnable = stats.filter("NOT held_out").join(known.filter(dice < share), "doc_id")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(16))
    model = fit(cut_lineage(learnable.withColumn("part", part), "labelled_stats"))
    return stats.select("doc_id", "held_out", "stats").mapInArrow(
        _scored(model, cut), f"doc_id {kind}, held_out boolean, score double, predicted int"
    )
