"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def components(rows, length=3, similar=90):
    """(id, number of shingles, smallest id reachable) of each (id, text)."""
    sets = []
    for _, text in rows:
        words = spaced_words((text or "").translate(_LOWER))
        grams = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)] or ([tuple(words)] if words else [])
        sets.append(frozenset(grams))
    parent, holders = list(range(len(rows))), defaultdict(list)

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for at, own in enumerate(sets):
        for other, n in Counter(o for gram in own for o in holders[gram]).items():
            if 100 * n >= similar * (len(own) + len(sets[other]) - n):
                parent[root(at)] = root(other)
        for gram in own:
            holders[gram].append(at)
    least = {}
    for at, (doc, _) in enumerate(rows):
        if sets[at] and doc is not None:
            least[root(at)] = min(least.get(root(at), doc), doc)
    return [
        (doc, len(sets[at]), least.get(root(at)) if sets[at] else doc) for at, (doc, _) in enumerate(rows)
    ]


def contamination(rows, items, length=13):
    """(id, n_words, n_hit, sorted item ids as text, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        size = min(len(words), length)
        for at in range(len(words) - size + 1) if words else ():
            windows[tuple(words[at : at + size])].add(str(item))
    sizes = {len(window) for window in windows}
    out = []
    for doc, text in rows:
        words, hit, found = plain_words(text), set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                names = windows.get(tuple(words[at : at + size]))
                if names:
                    hit.update(range(at, at + size))
                    found |= names
        out.append((doc, len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def line_dedup(rows):
    """(id, what stays) in the order of the input; equal rows are one document."""
    order = sorted({(doc is None, doc if doc is not None else 0, text) for doc, text in rows if text is not None})
    seen, gone = set(), defaultdict(set)
    for key in order:
        lines = key[2].split("\n")
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if not any(line.strip() for line in window):
                continue
            if window in seen:
                gone[key] |= {at, at + 1, at + 2}
            seen.add(window)
    out = []
    for doc, text in rows:
        lost = gone[(doc is None, doc if doc is not None else 0, text)] if text is not None else ()
        kept = None if text is None else "\n".join(x for at, x in enumerate(text.split("\n")) if at not in lost)
        out.append((doc, kept))
    return out


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = spaced_words(text)
    lines = [line for line in (text or "").split("\n") if spaced_words(line)]
    windows = [tuple(words[at : at + 8]) for at in range(len(words) - 7)]
    often = Counter(windows)
    covered = {at + k for at, window in enumerate(windows) if often[window] > 1 for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def propagate(seeds, edges, steps, damping):
    """Scores of hosts from {host: seed} over {(src, dst): n}."""
    total = Counter()
    for (src, _), n in edges.items():
        total[src] += n
    scores = {host: (1 - damping) * seed for host, seed in seeds.items()}
    for _ in range(steps):
        new = Counter({host: (1 - damping) * seed for host, seed in seeds.items()})
        for (src, dst), n in edges.items():
            new[dst] += damping * scores.get(src, 0.0) * n / total[src]
        scores = dict(new)
    return scores


def runs(words, least=24, times=3):
    """(start, length, period) of each run, by start and period: every period is tried on its own."""
    out = []
    for period in range(1, len(words) // times + 1):
        at = 0
        while at + period < len(words):
            if words[at] != words[at + period]:
                at += 1
                continue
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at + period - start
            stretch = words[start : start + length]
            smaller = any(stretch[q:] == stretch[:-q] for q in range(1, period))
            if length >= max(least, times * period) and not smaller:
                out.append((start, length, period))
    return sorted(out, key=lambda run: (run[0], run[2]))


def looped(doc, text):
    """Words of a text, every tenth id's ending in a loop."""
    words = spaced_words(text)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 0
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digest(doc, text):
    words = looped(doc, text)
    found, dropped = runs(words), set()
    for start, length, period in found:
        dropped |= set(range(start + period, start + length))
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    strongest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    kept = " ".join(word for at, word in enumerate(words) if at not in dropped)
    return (doc, len(found), *strongest, *(hashlib.sha256(s.encode()).hexdigest() for s in (listed, kept)))


def sequences(rows):
    """{sequence: tokens} of (sequence, offset, length); every sequence has to be without gaps."""
    held = defaultdict(list)
    for sequence, offset, length in rows:
        held[sequence].append((offset, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    return {sequence: sum(length for _, length in parts) for sequence, parts in held.items()}


def fewest_sequences(lengths, capacity):
    """The fewest sequences that hold the lengths, by trying everything."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[at]}:
            k = rooms.index(room)
            place(at + 1, [*rooms[:k], room - lengths[at], *rooms[k + 1 :]])
        place(at + 1, [*rooms, capacity - lengths[at]])

    place(0, [])
    return best if lengths else 0


def letter_grams(text):
    """Counter of the 1- to 3-grams of letters; words are padded with a blank on both sides."""
    counts = Counter()
    folded = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    for word in folded.split(" "):
        if word:
            padded = f" {word} "
            counts.update(word)
            counts.update(padded[at : at + 2] for at in range(len(padded) - 1))
            counts.update(padded[at : at + 3] for at in range(len(padded) - 2))
    return counts


def ranked_grams(counts, size=300):
    return sorted(counts, key=lambda gram: (-counts[gram], len(gram), gram))[:size]


def language(text, profiles, size=300):
    """(language, score) by out-of-place distance to rank lists."""
    own = ranked_grams(letter_grams(text), size)
    if not own:
        return "und", 0.0
    places = {lang: {gram: at for at, gram in enumerate(profile)} for lang, profile in profiles.items()}
    distance = {
        lang: sum(abs(known[gram] - at) if gram in known else size for at, gram in enumerate(own))
        for lang, known in places.items()
    }
    best = min(sorted(distance), key=distance.get)
    return best, 1 - distance[best] / (len(own) * size)


def statistics(text):
    """The fourteen figures of a text that the quality classifier reads."""
    text = text or ""
    words = spaced_words(text)
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\f\r")]
    chars = sum(c not in " \t\n\x0b\f\r" for c in text)
    n, lines_n = max(len(words), 1), max(len(lines), 1)

    def share(characters):
        return sum(c in characters for c in text) / max(chars, 1)

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return [
        math.log1p(chars), math.log1p(n), chars / n, len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        share("#*$%&"), share("|<>"), share("!?"), share(".,;:"), share("0123456789"), share(upper), share(upper.lower()),
        len(lines) / n, len(set(lines)) / lines_n,
    ]


def isotonic(values, weights):
    """Non-decreasing least squares by its min-max formula."""
    n = len(values)

    def mean(a, b):
        return sum(v * w for v, w in zip(values[a:b], weights[a:b], strict=True)) / sum(weights[a:b])

    return [max(min(mean(a, b) for b in range(at + 1, n + 1)) for a in range(at + 1)) for at in range(n)]
