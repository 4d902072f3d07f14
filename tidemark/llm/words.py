"""Words of whole texts as Arrow strings, cut on byte buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def bytes_in_words(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that marks the bytes words are made of: the given ASCII ranges, and all of every other character."""
    inside = np.zeros(256, dtype=bool)
    for low, high in ranges:
        inside[low : high + 1] = True
    inside[128:] = True
    return inside


def words_of(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """All words with A-Z lowered, end to end, and the offsets of each text's words among them.

    ``data`` and ``at`` are as ``arrow.utf8_view`` gives them; ``inside`` marks the bytes of words.
    """
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(at), np.int64)
    held = inside[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0], edge[1:-1], edge[-1] = True, ~held[:-1], True
    edge[at] = True
    first = np.flatnonzero(held & edge[:-1])
    edge[1:-1] = ~held[1:]
    edge[at] = True
    last = np.flatnonzero(held & edge[1:])
    ends = np.zeros(len(first) + 1, dtype=np.int32)
    np.cumsum(last - first + 1, out=ends[1:])
    kept = _LOWER[data[held]]
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(kept))
    return words, np.searchsorted(first, at)
