"""Column expressions that several operators share (all native)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Larger than any array, for "to the end" in slice().
_ALL = 2_000_000_000

#: Separators between words: what the contracts' word patterns leave out.
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _UPPER.lower())


def word_list(text: Column, separators: str = SPACE) -> Column:
    """Words of a text in order; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda word: word != "")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of the text are among `characters`."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def row_key(*values: Column) -> Column:
    """128 bits that stand for the values, nulls included; equal rows share them."""
    marked = [F.coalesce(F.concat(F.lit("v"), v.cast("string")), F.lit("n")) for v in values]
    sized = [part for v in marked for part in (F.length(v).cast("string"), v)]
    return F.unhex(F.md5(F.concat_ws(":", *sized)))


def zip_shifted(values: Column, shift: int, merge) -> Column:
    """merge(values[i], values[i + shift]) for each i; the last `shift` have null as second."""
    return F.zip_with(values, F.slice(values, shift + 1, _ALL), merge)


def grams(hashes: Column, length: int) -> Column:
    """A hash of each run of `length` neighbours, by doubling; only full runs.

    `hashes` should be a plain column, as it is used several times.
    """
    mixed = reduce(
        lambda run, bit: _extend(run, hashes, bit),
        bin(length)[3:],
        (hashes, 1),
    )[0]
    return F.slice(mixed, 1, F.greatest(F.size(hashes) - (length - 1), F.lit(0)))


def _extend(run: tuple[Column, int], hashes: Column, bit: str) -> tuple[Column, int]:
    doubled, width = zip_shifted(run[0], run[1], lambda a, b: F.xxhash64(a, b)), 2 * run[1]
    if bit == "1":
        rest = F.slice(hashes, width + 1, _ALL)
        doubled, width = F.zip_with(doubled, rest, lambda a, b: F.xxhash64(a, b)), width + 1
    return doubled, width
