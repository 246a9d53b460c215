"""Words of many texts at once: where they lie and 64-bit hashes of them, in numpy.

A word is a run of bytes other than space and 0x09-0x0D, within one text.
"""

from __future__ import annotations

import numpy as np
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers: list[np.ndarray] = []


def word_spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of the first word of each text (one more at the end).

    ``apart``: for each byte whether it parts words, white space if not given.
    """
    inside = ~(_SPACE if apart is None else apart)[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    tails = heads[heads > 0] - 1
    stops[tails] = inside[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Finisher of a 64-bit generator: each bit of the input moves half of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(2 * _CHUNK + 1, base, np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
    return _powers


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each word, by differences of prefix sums over bounded chunks; words beyond a chunk one by one."""
    powers, inverse = _power_tables()
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        base = starts[i]
        if ends[i] - base > _CHUNK:
            out[i], i = xxhash.xxh64_intdigest(data[base : ends[i]].tobytes(), 1), i + 1
            continue
        j = int(np.searchsorted(starts, base + _CHUNK))
        if ends[j - 1] - starts[j - 1] > _CHUNK:
            j -= 1
        n = int(ends[j - 1] - base)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[base : base + n].astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, first: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within one text, with the text's number and the run's first word in it."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    total = np.full(n, seed, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    place = np.arange(n) - first[text]
    fits = np.arange(n) + size <= first[text + 1]
    return mix(total[fits]), text[fits], place[fits]
