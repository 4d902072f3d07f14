"""Numbers that describe how a text is written, taken from all of its bytes."""

from __future__ import annotations

import numpy as np

from tidemark.llm.shingles import word_hashes

_CLASSES = ("lower", "upper", "digit", "blank", "feed", "stop", "bar", "mark", "high")
_LOWER, _UPPER, _DIGIT, _BLANK, _FEED, _STOP, _BAR, _MARK, _HIGH = range(len(_CLASSES))
_CLASS = np.full(256, _MARK, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = _LOWER, _UPPER, _DIGIT
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10], _CLASS[[46, 44, 59, 58]], _CLASS[124] = _BLANK, _FEED, _STOP, _BAR
_CLASS[:9], _CLASS[128:] = _MARK, _HIGH
_PAIRS = len(_CLASSES) ** 2
_EXTRA = 9
WIDTH = _PAIRS + _EXTRA


def style(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``WIDTH`` numbers per text; an empty text has all zeros.

    The shares of all pairs of neighbouring character classes, then the logarithms of the
    counts of words and lines, the mean length of words, the shares of distinct words, of
    words equal to the one before, of the most frequent word, of distinct word pairs, and
    of repeats at longer range.
    """
    rows = len(at) - 1
    out = np.zeros((rows, WIDTH), dtype=np.float32)
    if not len(data):
        return out
    kinds = _CLASS[data]
    pair = kinds[:-1] * np.uint8(len(_CLASSES)) + kinds[1:]
    sizes = np.diff(at)
    of_class = np.zeros((rows, len(_CLASSES)))
    for row, (low, high) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        if high > low:
            counts = np.bincount(pair[low : high - 1], minlength=_PAIRS)
            out[row, :_PAIRS] = counts / max(high - low - 1, 1)
            of_class[row] = counts.reshape(len(_CLASSES), -1).sum(axis=1)
            of_class[row, kinds[high - 1]] += 1
    words, begins = word_hashes(data, at)
    number = np.diff(begins)
    feeds = of_class[:, _FEED]
    solid = sizes - feeds - of_class[:, _BLANK]
    extra = out[:, _PAIRS:]
    extra[:, 0], extra[:, 1] = np.log1p(number), np.log1p(feeds)
    extra[:, 2] = solid / np.maximum(number, 1) / 10
    for row, (low, high) in enumerate(zip(begins[:-1], begins[1:], strict=True)):
        own = words[low:high]
        if not len(own):
            continue
        ordered = np.sort(own)
        cuts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        extra[row, 3] = len(cuts) / len(own)
        extra[row, 4] = np.diff(cuts, append=len(own)).max() / len(own)
        if len(own) > 1:
            extra[row, 5] = (own[1:] == own[:-1]).mean()
            twos = np.sort(own[1:] * np.uint64(3) + own[:-1])
            extra[row, 6] = (1 + (twos[1:] != twos[:-1]).sum()) / len(twos)
        if len(own) > 4:
            fives = np.sort(own[4:] * np.uint64(5) + own[3:-1] * np.uint64(7) + own[2:-2] * np.uint64(11) + own[1:-3] * np.uint64(13) + own[:-4])
            extra[row, 7] = (1 + (fives[1:] != fives[:-1]).sum()) / len(fives)
        extra[row, 8] = len(cuts) / np.sqrt(len(own)) / 10
    return out
