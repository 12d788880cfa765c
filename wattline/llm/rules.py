"""Quality rules as a short-circuit cascade (native).

Each rule is a failing condition over a few text statistics. On a bounded sample the
cascade estimates what a rule costs and how much it rejects; rules then run in the
order of rejection per cost, and a document that fails one is not asked the next
(`CASE WHEN` stops at the first hit, and the costly statistics stand only inside it).
The order changes the cost and the rule that is named, never whether a document is kept.

Cases: a null or empty text has no words and fails the base rules; repeated rows are
judged row by row; empty tables give empty results; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.columns import SPACE, count_of, grams, word_list, zip_shifted

SYMBOLS = "#*$%&|<>"
#: Words in a window whose repetition counts.
REPEAT_WINDOW = 8
#: The cascade's estimates come from a sample of this expected size.
SAMPLE_ROWS = 2_000


def _repeated_positions(windows: Column) -> Column:
    """Positions (from 0, ascending) of windows that occur more than once."""
    ranked = F.sort_array(F.transform(windows, lambda value, at: F.struct(value.alias("v"), at.alias("i"))))
    pairs = zip_shifted(ranked, 1, lambda a, b: F.when(a["v"] == b["v"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda pair: pair.isNotNull()))))


def _covered(positions: Column, width: int) -> Column:
    """Words covered by windows of `width` words that start at ascending positions."""
    steps = zip_shifted(positions, 1, lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id as `doc_id`, `text`, word list and the base counts.

    Words are runs of other characters than blank and \\t..\\r. `n_repeat_words` counts the
    words inside 8-word windows that occur twice or more in the text.
    """
    words = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        word_list(F.col(text_col), SPACE).alias("words"),
    )
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    counted = words.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        lines.alias("lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    windowed = counted.select(
        "doc_id",
        "text",
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        grams(F.col("hashes"), REPEAT_WINDOW).alias("windows"),
    )
    repeated = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        _covered(_repeated_positions(F.col("windows")), REPEAT_WINDOW),
    ).otherwise(F.lit(0).cast("long"))
    return windowed.select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        repeated.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """Under 20 words, or more than 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """A failing condition, and its cost in characters it looks at."""

    name: str
    fails: Column
    cost: Column


def default_rules() -> list[Rule]:
    """Rules beyond the base ones; integer arithmetic, so that every engine agrees."""
    text, chars = F.col("text"), F.length("text")
    upper = count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    lower = count_of(text, "abcdefghijklmnopqrstuvwxyz")
    return [
        Rule("symbols", 10 * F.col("n_symbols") > F.col("n_words"), F.lit(1)),
        Rule(
            "word length",
            (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
            F.lit(1),
        ),
        Rule("duplicate lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"), F.lit(1)),
        Rule("exclamations", 4 * count_of(text, "!") > F.col("n_words"), chars),
        Rule("capitals", upper > lower, 2 * chars),
        Rule("digits", 4 * count_of(text, "0123456789") > F.col("word_chars"), chars),
    ]


def ordered_rules(
    docs: DataFrame,
    rules: Sequence[Rule],
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list[Rule]:
    """Rules by rejection per cost, as estimated on a sample that a hash of the row picks.

    `sample_rows` is the expected size of the sample; only one row of averages is collected.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    share = min(1.0, sample_rows / max(docs.count(), 1))
    dice = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 32) - 1)) / float(1 << 32)
    picked = narrow.filter(dice < share)
    averages = [
        column
        for at, rule in enumerate(rules)
        for column in (
            F.avg(F.coalesce(rule.fails, F.lit(False)).cast("double")).alias(f"r{at}"),
            F.avg(rule.cost.cast("double")).alias(f"c{at}"),
        )
    ]
    seen = statistics(picked).agg(*averages).first()
    gain = [(seen[f"r{at}"] or 0.0) / max(seen[f"c{at}"] or 1.0, 1.0) for at in range(len(rules))]
    return [rules[at] for at in sorted(range(len(rules)), key=lambda at: (-gain[at], rules[at].name))]


def cascade(
    docs: DataFrame,
    rules: Sequence[Rule] | None = None,
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: base counts, `base_failed`, the first failed rule in cascade order and `kept`."""
    rules = default_rules() if rules is None else list(rules)
    stats = statistics(docs, id_col, text_col)
    order = ordered_rules(docs, rules, sample_rows, id_col, text_col)
    first = F.when(F.col("base_failed"), F.lit("base"))
    for rule in order:
        first = first.when(rule.fails, F.lit(rule.name))
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rejected_by", first)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "base_failed", "rejected_by", F.col("rejected_by").isNull().alias("kept"),
    )
