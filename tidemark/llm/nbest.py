"""N-best segmentation of whole texts over a piece vocabulary, and decoding."""

from __future__ import annotations

import gc
import heapq
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices

NBEST = 3
REMEMBERED = 900_000
MANY, TOGETHER, LONGEST = 32, 1 << 14, 64  # strings of one length that are searched together, and their length
UNKNOWN_PENALTY = 10.0
SPACE = "▁"
_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

Paths = list[tuple[float, bytes]]
"""Segmentations of a string, best first: score, and ids as little-endian 32-bit bytes."""


class Lattice:
    """A vocabulary of scored pieces over which strings are cut into pieces."""

    def __init__(self, scores: dict[str, tuple[float, bytes]], raw_bytes: list[bytes], unknown: float):
        self.raw_bytes, self.unknown = raw_bytes, unknown
        self.pairs = {piece[k : k + 2] for piece in scores for k in range(len(piece) - 1)}
        self.pair_keys = np.array([ord(a) << 21 | ord(b) for a, b in self.pairs], dtype=np.int64)
        self.known = dict.fromkeys((piece[:k] for piece in scores for k in range(1, len(piece) + 1)))
        self.known.update(scores)
        # the same as numbered states, the empty beginning first, and sorted steps from state and character to state
        state = {"": 0} | {piece: i for i, piece in enumerate(self.known, 1)}
        self.chars = np.unique(np.array([ord(piece[-1]) for piece in self.known], dtype=np.int64))
        letter = {c: i for i, c in enumerate(self.chars.tolist())}
        steps = np.array([state[p[:-1]] * len(letter) + letter[ord(p[-1])] for p in self.known], dtype=np.int64)
        order = np.argsort(steps)
        self.steps, self.targets = steps[order], order + 1
        self.worth = np.array([np.nan, *[found[0] if found else np.nan for found in self.known.values()]])
        self.ids = [b"", *[found[1] if found else b"" for found in self.known.values()]]

    def search(self, text: str, n: int) -> Paths:
        """The ``n`` best ways to cut ``text``, by backward A* search.

        The forward pass gives the best score of every prefix and, per place, the pieces
        that end there with the best score through each. That is exactly what is still to
        come for a suffix cut so far, so the search goes straight back along best pieces
        and only queues, at each place, the next best one. Equal scores come in the order
        of the search.
        """
        known, size = self.known, len(text)
        best = [0.0] + [-np.inf] * size
        arcs: list[list] = [[] for _ in range(size + 1)]
        for begin in range(size):
            base = best[begin]
            for end in range(begin + 1, size + 1):
                found = known.get(text[begin:end], False)  # None: only the beginning of a piece
                if found:
                    through, piece = base + found[0], found[1]
                elif end == begin + 1:  # a character that is no piece goes by its bytes
                    raw = text[begin].encode("utf-8", "surrogatepass")
                    through, piece = base + self.unknown, b"".join([self.raw_bytes[b] for b in raw])
                elif found is None:
                    continue
                else:
                    break
                arcs[end].append((through, begin, piece))
                if through > best[end]:
                    best[end] = through
        heap, out, turn, ordered = [(-best[size], 0, size, 0, 0.0, b"")], [], 0, set()
        while heap and len(out) < n:
            _, _, place, choice, done, ids = heapq.heappop(heap)
            while place:
                own = arcs[place]
                if place not in ordered:
                    ordered.add(place)
                    own.sort(reverse=True)
                if choice + 1 < len(own):
                    turn += 1
                    heapq.heappush(heap, (-(done + own[choice + 1][0]), turn, place, choice + 1, done, ids))
                through, begin, piece = own[choice]
                done += through - best[begin]
                ids, place, choice = piece + ids, begin, 0
            out.append((done, ids))
        return out

    def best(self, text: str) -> tuple[bytes, float, float]:
        """Ids and score of the best way to cut ``text``, and what the next best loses.

        The next best leaves the best, seen from the end, at some place on it, by another
        piece that ends there and the best before that piece. So the forward pass that
        ``search`` takes as its heuristic knows it, if it keeps the best two per place.
        """
        known, size, unknown, raw_bytes = self.known, len(text), self.unknown, self.raw_bytes
        first, second = [-np.inf] * (size + 1), [-np.inf] * (size + 1)
        back, pieces = [0] * (size + 1), [b""] * (size + 1)
        first[0] = 0.0
        for begin in range(size):
            base = first[begin]
            for end in range(begin + 1, size + 1):
                found = known.get(text[begin:end], False)
                if found:
                    through, piece = found
                    through += base
                elif end == begin + 1:
                    through = base + unknown
                    piece = b"".join([raw_bytes[b] for b in text[begin].encode("utf-8", "surrogatepass")])
                elif found is None:
                    continue
                else:
                    break
                if through >= first[end]:
                    second[end] = first[end]
                    first[end], back[end], pieces[end] = through, begin, piece
                elif through > second[end]:
                    second[end] = through
        loss, place, taken = np.inf, size, []
        while place:
            if first[place] - second[place] < loss:
                loss = first[place] - second[place]
            taken.append(pieces[place])
            place = back[place]
        taken.reverse()
        return b"".join(taken), first[size], loss

    def best_of_many(self, texts: list[str]) -> list[tuple[bytes, float, float]]:
        """``best`` of strings of one length, all in one pass: the same sums in the same order."""
        count, size = len(texts), len(texts[0])
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(count, size).astype(np.int64)
        letters = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        letters[self.chars[letters] != points] = -1
        first, second = (np.full((size + 1, count), -np.inf) for _ in range(2))
        back, piece = (np.zeros((size + 1, count), dtype=np.int64) for _ in range(2))
        first[0] = 0.0
        for begin in range(size):
            rows, state, base = np.arange(count), np.zeros(count, dtype=np.int64), first[begin]
            for end in range(begin + 1, size + 1):
                letter = letters[rows, end - 1]
                step = state * len(self.chars) + letter
                at = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
                alive = (self.steps[at] == step) & (letter >= 0)
                reached = np.where(alive, self.targets[at], 0)
                worth = self.worth[reached]
                ends = ~np.isnan(worth)
                if end == begin + 1:  # a character that is no piece goes by its bytes, under state 0
                    worth, reached, ends = np.where(ends, worth, self.unknown), np.where(ends, reached, 0), np.ones(count, dtype=bool)
                row, through = rows[ends], base[rows[ends]] + worth[ends]
                best = first[end, row]
                better = through >= best
                second[end, row] = np.where(better, best, np.maximum(second[end, row], through))
                won = row[better]
                first[end, won], back[end, won], piece[end, won] = through[better], begin, reached[ends][better]
                rows, state = rows[alive], self.targets[at][alive]
                if not len(rows):
                    break
        place, losses = np.full(count, size), np.full(count, np.inf)
        cuts: list[list[bytes]] = [[] for _ in texts]
        rows = np.arange(count)
        while len(rows):
            here = place[rows]
            losses[rows] = np.minimum(losses[rows], first[here, rows] - second[here, rows])
            start = back[here, rows]
            for row, taken, begin in zip(rows.tolist(), piece[here, rows].tolist(), start.tolist(), strict=True):
                if taken:
                    cuts[row].append(self.ids[taken])
                else:
                    raw = texts[row][begin].encode("utf-8", "surrogatepass")
                    cuts[row].append(b"".join([self.raw_bytes[b] for b in raw]))
            place[rows] = start
            rows = rows[start > 0]
        return [(b"".join(cut[::-1]), score, loss) for cut, score, loss in zip(cuts, first[size].tolist(), losses.tolist(), strict=True)]

    def parts(self, text: str) -> list[str]:
        """A string cut where no piece of the vocabulary holds both neighbours."""
        pairs, out, begin = self.pairs, [], 0
        for k in range(1, len(text)):
            if text[k - 1 : k + 1] not in pairs:
                out.append(text[begin:k])
                begin = k
        return [*out, text[begin:]]

    def parts_of_many(self, texts: list[str]) -> list[list[str]]:
        """``parts`` of many strings that are not empty, in one pass."""
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        sizes = np.array([len(text) for text in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        opens = np.ones(len(points), dtype=bool)
        opens[1:] = ~np.isin((points[:-1] << 21) | points[1:], self.pair_keys)
        opens[(ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(opens)
        stops = np.append(starts[1:], len(points))
        pieces = [whole[low:high] for low, high in zip(starts.tolist(), stops[: len(starts)].tolist(), strict=True)]
        last = np.searchsorted(starts, ends).tolist()
        return [pieces[low:high] for low, high in zip([0, *last[:-1]], last, strict=True)] if texts else []

    def cut(self, text: str, n: int) -> Paths:
        """As ``search``, part by part."""
        first, *rest = self.parts(text)
        whole = self.search(first, n)
        for part in rest:
            pairs_of = [(a + b, x + y) for a, x in whole for b, y in self.search(part, n)]
            whole = heapq.nsmallest(n, pairs_of, key=lambda pair: -pair[0])
        return whole


class _Words(dict):
    """Per word met lately: ids and score of its best path, and what the next best loses.

    Words come into the dictionary itself; when half of what may be remembered is there,
    it becomes the older half, from which words still in use come back.
    """

    def __init__(self, lattice: Lattice):
        super().__init__()
        self.lattice = lattice
        self.older: dict[str, tuple[bytes, float, float]] = {}

    def learn(self, words: set[str]) -> None:
        """Meet many words at once; their parts of one length are searched together."""
        fresh = [word for word in words if word not in self and word not in self.older]
        parts_of = self.lattice.parts_of_many(fresh)
        by_size: dict[int, list[str]] = {}
        for part in {part for parts in parts_of for part in parts}:
            if part not in self and part not in self.older:
                by_size.setdefault(len(part), []).append(part)
        for size, parts in by_size.items():
            if MANY <= len(parts) and size <= LONGEST:
                for low in range(0, len(parts), TOGETHER):
                    some = parts[low : low + TOGETHER]
                    self.update(zip(some, self.lattice.best_of_many(some), strict=True))
        for word, parts in zip(fresh, parts_of, strict=True):
            if len(parts) > 1:
                self[word] = self.joined(parts)

    def joined(self, parts: list[str]) -> tuple[bytes, float, float]:
        """The best of a whole from that of its parts; the next best is that of one part."""
        ids, scores, losses = zip(*[self[part] for part in parts], strict=True)
        return b"".join(ids), sum(scores), min(losses)

    def __missing__(self, word: str) -> tuple[bytes, float, float]:
        if 2 * len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        found = self.older.get(word)
        if found is None:
            parts = self.lattice.parts(word)
            found = self.joined(parts) if len(parts) > 1 else self.lattice.best(word)
        self[word] = found
        return found


class Segmenter:
    """N-best segmentation and decoding with the vocabulary and normaliser of a model file."""

    def __init__(self, path: str, n: int):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.normalize, self.n = model.normalize, n
        ids = range(model.get_piece_size())
        named = [(i, model.id_to_piece(i)) for i in ids if not (model.is_control(i) or model.is_unknown(i))]
        whole = [(i, p) for i, p in named if not model.is_byte(i)]
        raw = {int(p[3:5], 16): _as_bytes(i) for i, p in named if model.is_byte(i)}
        scores = {p: (model.get_score(i), _as_bytes(i)) for i, p in whole}
        unknown = min(score for score, _ in scores.values()) - UNKNOWN_PENALTY
        fallback = [raw.get(b, _as_bytes(model.unk_id())) for b in range(256)]
        self.lattice = Lattice(scores, fallback, unknown)
        self.words = _Words(self.lattice)
        self.written = [b"" for _ in ids]
        for i, piece in named:
            self.written[i] = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.encode()
        inner = any(SPACE in piece.lstrip(SPACE) for _, piece in whole)
        self.split = (lambda text: [text] if text else []) if inner else _words

    def ranked(self, text: str) -> list[tuple[float, bytes, tuple]]:
        """The best segmentations of a whole text, each with the words it cuts unlike the first.

        Pieces never reach over the start of a word, so every word is cut by itself. The
        ``n`` best of the text can differ from its best only in the ``n - 1`` words that
        lose least by it, whose paths are joined one after the other.
        """
        return self.ranked_words(self.words_of(text))

    def words_of(self, text: str) -> list[str]:
        return self.split(self.normalize(text))

    def ranked_words(self, words: list[str]) -> list[tuple[float, bytes, tuple]]:
        """As ``ranked``, of a text's words."""
        if not words:
            return [(0.0, b"", ())]
        ids, scores, losses = zip(*map(self.words.__getitem__, words), strict=True)
        score = float(sum(scores))
        out = [(score, b"".join(ids), ())]
        if self.n == 1:
            return out
        losses = np.array(losses)
        count = min(self.n - 1, len(words))
        cheap = np.argpartition(losses, count - 1)[:count]
        choices: list[tuple[float, dict[int, bytes]]] = [(0.0, {})]
        for place in sorted(cheap.tolist()):
            paths = self.lattice.cut(words[place], self.n)
            pairs = [
                (loss + paths[0][0] - worth, {**chosen, place: own} if k else chosen)
                for loss, chosen in choices
                for k, (worth, own) in enumerate(paths)
            ]
            choices = heapq.nsmallest(self.n, pairs, key=lambda pair: pair[0])
        for loss, chosen in choices[1:]:
            other = list(ids)
            for place, own in chosen.items():
                other[place] = own
            swapped = tuple((ids[place], own) for place, own in chosen.items())
            out.append((score - loss, b"".join(other), swapped))
        return out

    def encode(self, text: str) -> Paths:
        return [(score, ids) for score, ids, _ in self.ranked(text)]

    def written_alike(self, swapped: tuple[tuple[bytes, bytes], ...]) -> bool:
        """Whether other cuts of some words stand for the same characters."""
        return all(self._bytes(one) == self._bytes(other) for one, other in swapped)

    def _bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.written.__getitem__, array("I", ids)))

    def decode(self, ids: bytes) -> str:
        """The text of pieces; the blank that opens every text is taken off again."""
        text = self._bytes(ids).decode("utf-8", "replace")
        return text.replace(SPACE, " ").removeprefix(" ")


def _as_bytes(number: int) -> bytes:
    return array("I", [number]).tobytes()


def _words(text: str) -> list[str]:
    if SPACE * 2 in text or text[-1:] == SPACE or text[:1] != SPACE:
        return _RUNS(text)
    return [SPACE + word for word in text[1:].split(SPACE)]


def segmenter(path: str, n: int) -> Segmenter:
    """The process's segmenter for a file, kept between tasks."""
    kept = sys.modules.setdefault("_tidemark_segmenters", types.ModuleType("_tidemark_segmenters"))
    name = f"{n}:{path}"
    if name not in kept.__dict__:
        kept.__dict__[name] = Segmenter(path, n)
    return kept.__dict__[name]


def segmentations(
    docs: DataFrame, model: str, n: int = NBEST, key: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """The ``n`` best segmentations of every whole text, decoded again.

    One row per document and ``rank`` from 1: ``score`` (sum of the pieces' scores),
    ``n_pieces``, ``ids_crc32`` (ids as little-endian unsigned 32-bit integers),
    ``round_trip`` (the ids decode to the text as it was; beyond the first rank, the words
    that are cut otherwise decode alike) and ``ids``. Scores fall with the
    rank; segmentations differ; a text with fewer ways to be cut has fewer rows, an empty
    or null one a single row without pieces. A character outside the vocabulary goes by
    its bytes, at the score of the worst piece less ``UNKNOWN_PENALTY``. Texts that hold
    the vocabulary's own blank sign do not round-trip. Repeated rows and null ids are rows
    like others, other columns are left out, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here refers to itself, and each pass would walk all remembered words
        try:
            yield from segmented(batches, segmenter(model, n))
        finally:
            gc.enable()

    def segmented(batches: Iterator[pa.RecordBatch], tool: Segmenter) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, ranks, scores, sizes, sums, trips, ids = [], [], [], [], [], [], []
            texts = batch.column("text").to_pylist()
            words = [tool.words_of(text) for text in texts]
            tool.words.learn(set().union(*words))
            for row, whole in enumerate(texts):
                same = False
                for rank, (score, pieces, swapped) in enumerate(tool.ranked_words(words[row]), 1):
                    same = tool.written_alike(swapped) and same if swapped else tool.decode(pieces) == whole
                    rows.append(row)
                    ranks.append(rank)
                    scores.append(score)
                    sizes.append(len(pieces) // 4)
                    sums.append(zlib.crc32(pieces))
                    trips.append(same)
                    if with_ids:
                        ids.append(pieces)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())),
                "rank": pa.array(ranks, pa.int32()),
                "score": pa.array(scores, pa.float64()),
                "n_pieces": pa.array(sizes, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
                "round_trip": pa.array(trips, pa.bool_()),
            }
            if with_ids:
                flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(at), pa.array(flat))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean"
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)
