"""Word shingles of whole texts as sorted 64-bit hashes, computed on byte buffers."""

from __future__ import annotations

import numpy as np

from tidemark.llm.arrow import mixed, stream_of

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand and kept."""
    if not _POWERS or len(_POWERS[0]) < count:
        size = max(count, 1 << 20)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            tables.append(np.cumprod(row, dtype=np.uint64))
        _POWERS[:] = tables
    return _POWERS[0][:count], _POWERS[1][:count]


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, A-Z lowered, and the offsets of each text's words among them."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    lowered = _LOWER[data]
    inside = _IN_WORD[data]
    opens = np.empty(len(data) + 1, dtype=bool)
    opens[0], opens[1:-1], opens[-1] = True, ~inside[:-1], True
    opens[at] = True
    first = np.flatnonzero(inside & opens[:-1])
    after = np.empty(len(data), dtype=bool)
    after[:-1], after[-1] = ~inside[1:], True
    after[at[at > 0] - 1] = True
    last = np.flatnonzero(inside & after)
    up, down = _powers(len(data))
    total = np.cumsum(lowered.astype(np.uint64) * up, dtype=np.uint64)
    words = total[last] - np.where(first > 0, total[first - 1], np.uint64(0))
    words = mixed(words * down[first] + (last - first + 1).astype(np.uint64))
    return words, np.searchsorted(first, at)


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, end to end, and their offsets.

    A text with fewer words than ``width`` has all its words as its one shingle; a text
    without words has none.
    """
    words, begins = word_hashes(data, at)
    weights = stream_of(11, width)
    counts = np.diff(begins)
    n = len(words)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(min(width, n)):
        rolled[: n - k] += words[k:] * (weights[k] | np.uint64(1))
    rolled = mixed(rolled)
    sets, sizes = [], np.zeros(len(counts), dtype=np.int64)
    for row, (low, size) in enumerate(zip(begins[:-1], counts, strict=True)):
        if size == 0:
            continue
        if size < width:
            whole = (words[low : low + size] * (weights[:size] | np.uint64(1))).sum(dtype=np.uint64)
            found = mixed(np.array([whole + np.uint64(size)], dtype=np.uint64) ^ weights[0])
        else:
            found = np.sort(rolled[low : low + size - width + 1])
            fresh = np.empty(len(found), dtype=bool)
            fresh[0] = True
            np.not_equal(found[1:], found[:-1], out=fresh[1:])
            found = found[fresh]
        sets.append(found)
        sizes[row] = len(found)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), ends
