"""Word shingles of whole texts as 64-bit numbers, many texts at a time.

A word is a run of bytes other than white space (0x20, 0x09-0x0D), A-Z in lower case.
A text's set holds every run of ``width`` words; a text with fewer words has one shingle,
the whole sequence; a text without words has none.
"""

from __future__ import annotations

import numpy as np

from textloom.llm.batches import row_slices

WIDTH = 5
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20_240_601)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2**64
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_STEP, _BACK)):
            row = np.full(n + n // 4, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, word offsets by row)`` of rows that lie in ``data`` one after another."""
    n = len(data)
    bounds = np.zeros(n + 1, bool)
    bounds[offsets] = True
    blank = BLANK[data]
    start = np.flatnonzero(~blank & (np.concatenate([[True], blank[:-1]]) | bounds[:n]))
    end = np.flatnonzero(~blank & (np.concatenate([blank[1:], [True]]) | bounds[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit number per word, A-Z in lower case; a megabyte of words at a time."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(int(np.searchsorted(end, start[i] + CHUNK, "right")), i + 1)
        lo, hi = int(start[i]), int(end[j - 1])
        forward, backward = _powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[data[lo:hi]]] * forward[:-1], out=total[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * backward[s] + (e - s).astype(np.uint64))
        i = j
    return out


def run_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit number per run of words ``start:end``."""
    forward, backward = _powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * forward[:-1], out=total[1:])
    return mix((total[end] - total[start]) * backward[start] + (end - start).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """``(shingles, offsets)``: each row's distinct shingles in ascending order."""
    start, end, at = word_spans(data, offsets)
    words = word_hashes(data, start, end)
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64), at
    counts = np.diff(at)
    row = np.repeat(np.arange(len(counts)), counts)
    place, stop = np.arange(n), at[1:][row]
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    h = np.minimum(stop - place, width).astype(np.uint64) * _PLACE[-1]
    for j in range(width):
        h += np.where(place + j < stop, padded[j:j + n] * _PLACE[j], np.uint64(0))
    whole = (place + width <= stop) | (place == at[:-1][row])
    h, row = mix(h[whole]), row[whole]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(counts) + 1))


def sets_by_slice(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH):
    """``(i, j, shingles, offsets)`` for slices of whole rows of bounded size."""
    for i, j in row_slices(offsets):
        part = offsets[i:j + 1]
        yield i, j, *shingle_sets(data[part[0]:part[-1]], part - part[0], width)
