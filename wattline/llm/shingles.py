"""Word shingles of many texts at once, as 64-bit numbers (numpy, no loop over words)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters hashed at once; a longer text is taken alone.
CHUNK_BYTES = 400_000

_RANDOM = np.random.default_rng(7)
#: A random number per byte, and an odd base whose powers tell positions in a word apart.
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RANDOM.integers(0, 1 << 62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, np.uint64(base & ((1 << 64) - 1)))
    powers[0] = 1
    return np.multiply.accumulate(powers)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, encoded lower-case texts) of bounded groups."""
    first, held, size = 0, [], 0
    for at, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
        if held and size + len(data) > CHUNK_BYTES:
            yield first, held
            first, held, size = at, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words start (one more at the end)."""
    data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    if not len(data):
        return np.array([], dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), dtype=np.uint64)])
    hashes = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts]
    borders = np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])])
    return mixed(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, borders)


def shingle_lists(texts: list[bytes], length: int) -> Iterator[np.ndarray]:
    """Per text its shingle hashes with repeats; a shorter text that has words is one shingle."""
    hashes, borders = word_hashes(texts)
    run = hashes.copy()
    for at in range(1, length):
        run[: len(run) - at] = mixed(run[: len(run) - at] * np.uint64(0x9E3779B97F4A7C15) + hashes[at:])
    for start, end in zip(borders[:-1], borders[1:], strict=True):
        if end - start >= length:
            yield run[start : end - length + 1]
        elif end > start:
            value = np.full(1, np.uint64(end - start))
            for word in hashes[start:end]:
                value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + word)
            yield value
        else:
            yield hashes[:0]
