"""Benchmark passages in training documents, found with a positional inverted index.

The index is cut by documents: a block holds the postings of a few megabytes of text, one
row per term with the places of that term in the block, and one row per document with the
places it covers. A term that stands everywhere therefore has one row of bounded length in
each block and never gathers. A search takes from the stored index only the postings of
its own terms, brings those of a block together, and intersects them there window by
window: the places of the window's rarest term, moved back by its offset, are looked up in
the list of the next rarest moved by its own, and so on until none or the phrase is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices, utf8_view
from tidemark.llm.words import bytes_in_words, words_of
from tidemark.session import store

WIDTH = 10
ITEM_WORDS = 1 << 20
SEGMENT_WORDS = 4096
CANDIDATES = 1 << 18
WORD_BYTES = bytes_in_words((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))

INDEX = "block long, term string, gaps array<int>, doc_id long, number int, first int, n_words int"


def index_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings and documents of every block.

    A posting row has ``term`` and ``gaps``: the first place of the term in the block,
    then the steps from each place to the next. A document row has no term; it has its
    id, its number within the block, its first place and its words. Words are runs of
    digits, letters and all characters beyond ASCII, A-Z lowered; null text has none.
    Each row of ``docs`` is a document, also where ids repeat or are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text"):
            words, begins = words_of(*utf8_view(batch.column("text")), WORD_BYTES)
            coded = words.dictionary_encode()
            terms, codes = coded.dictionary, np.asarray(coded.indices)
            order = np.argsort(codes, kind="stable").astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(terms)))]).astype(np.int32)
            gaps = np.diff(order, prepend=np.int32(0))
            gaps[ends[:-1]] = order[ends[:-1]]
            yield _rows(block, term=terms, gaps=pa.ListArray.from_arrays(pa.array(ends), pa.array(gaps)))
            yield _rows(
                block,
                doc_id=batch.column("doc_id"),
                number=pa.array(np.arange(batch.num_rows, dtype=np.int32)),
                first=pa.array(begins[:-1].astype(np.int32)),
                n_words=pa.array(np.diff(begins).astype(np.int32)),
            )
            block += 1

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, INDEX)


_KINDS = {
    "block": pa.int64(), "term": pa.string(), "gaps": pa.list_(pa.int32()), "doc_id": pa.int64(),
    "number": pa.int32(), "first": pa.int32(), "n_words": pa.int32(),
}


def _rows(block: int, **columns: pa.Array) -> pa.RecordBatch:
    """A batch of the index; what is not given is null."""
    count = len(next(iter(columns.values())))
    columns["block"] = pa.array(np.full(count, block, dtype=np.int64))
    return pa.RecordBatch.from_arrays(
        [columns[n].cast(kind) if n in columns else pa.nulls(count, kind) for n, kind in _KINDS.items()], names=list(_KINDS)
    )


def write_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Store the index as Parquet; it can be searched any number of times."""
    index_rows(docs, key, text).write.option("compression", "zstd").parquet(path)


def item_segments(items: DataFrame, key: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Words of every item, long items cut so that each window of ``width`` words lies in one segment: ``item``, ``words``.

    Items without words do not appear; a null id counts as empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, begins = words_of(*utf8_view(batch.column("text")), WORD_BYTES)
            names, lists = [], []
            for name, low, high in zip(batch.column("item").to_pylist(), begins[:-1], begins[1:], strict=True):
                for at in range(low, max(high - width + 1, low + 1), SEGMENT_WORDS):
                    part = words.slice(at, min(high - at, SEGMENT_WORDS + width - 1))
                    if len(part):
                        names.append(name)
                        lists.append(part.to_pylist())
            yield pa.RecordBatch.from_pydict(
                {"item": pa.array(names, pa.string()), "words": pa.array(lists, pa.list_(pa.string()))}
            )

    rows = items.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, "item string, words array<string>")


@dataclass
class Windows:
    """Distinct windows of some items: term numbers, -1 after a short one's end, and the items each belongs to."""

    terms: pa.Array
    rows: np.ndarray
    sizes: np.ndarray
    items: list[list[str]]


def windows_of(segments: list, width: int) -> Windows:
    """All windows of the segments, each once."""
    numbers: dict[str, int] = {}
    found: dict[tuple, set[str]] = {}
    for segment in segments:
        codes = [numbers.setdefault(w, len(numbers)) for w in segment.words]
        for at in range(max(len(codes) - width + 1, 1)):
            found.setdefault(tuple(codes[at : at + width]), set()).add(segment.item)
    rows = np.full((len(found), width), -1, dtype=np.int64)
    for row, window in zip(rows, found, strict=True):
        row[: len(window)] = window
    return Windows(
        pa.array(list(numbers), pa.string()), rows, (rows >= 0).sum(axis=1), [sorted(names) for names in found.values()]
    )


class Block:
    """The postings of a block that a search asks for, as one sorted list of (term, place)."""

    def __init__(self, table: pa.Table, terms: pa.Array):
        docs = table.filter(pc.is_null(table.column("term")))
        self.docs = docs.sort_by("number")
        self.first = np.asarray(self.docs.column("first"), dtype=np.int64)
        self.n_words = np.asarray(self.docs.column("n_words"), dtype=np.int64)
        postings = table.filter(pc.is_in(table.column("term"), value_set=terms))
        codes = np.asarray(pc.index_in(postings.column("term"), value_set=terms).combine_chunks(), dtype=np.int64)
        postings = postings.take(pa.array(np.argsort(codes)))
        codes.sort()
        gaps = postings.column("gaps").combine_chunks()
        sizes = np.asarray(pc.list_value_length(gaps), dtype=np.int64)
        steps = np.asarray(gaps.flatten(), dtype=np.int64)
        ends = np.cumsum(sizes)
        places = np.cumsum(steps)
        before = np.concatenate([[0], places[ends[:-1] - 1]]) if len(sizes) else np.empty(0, np.int64)
        places -= np.repeat(before, sizes)
        self.places = places
        self.keys = (np.repeat(codes, sizes) << 32) | places
        self.counts = np.zeros(len(terms) + 1, dtype=np.int64)
        self.counts[codes] = sizes
        self.begins = np.zeros(len(terms) + 1, dtype=np.int64)
        self.begins[codes] = ends - sizes

    def has(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each term stands at its place."""
        wanted = (terms << 32) | places
        at = np.searchsorted(self.keys, wanted)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1

    def rarest_first(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Windows all whose terms stand in the block, and the order of their offsets by how often the terms do."""
        counts = np.where(windows.rows >= 0, self.counts[windows.rows], np.iinfo(np.int64).max)
        alive = np.flatnonzero((counts > 0).all(axis=1))
        return alive, np.argsort(counts[alive], axis=1, kind="stable")

    def anchors(self, windows: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Window, order of offsets and place for every place of every window's rarest term, in lists of bounded length."""
        alive, order = self.rarest_first(windows)
        if not len(alive):
            return
        rarest = windows.rows[alive, order[:, 0]]
        ends = np.cumsum(self.counts[rarest])
        low, total = 0, int(ends[-1])
        while low < total:
            high = min(low + CANDIDATES, total)
            place = np.arange(low, high)
            row = np.searchsorted(ends, place, side="right")
            nth = place - (ends[row] - self.counts[rarest[row]])
            yield alive[row], order[row], self.places[self.begins[rarest[row]] + nth]
            low = high

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Window and first place of every exact occurrence within one document."""
        out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for window, order, place in self.anchors(windows):
            start = place - order[:, 0]
            keep = np.flatnonzero(start >= 0)
            window, order, start = window[keep], order[keep], start[keep]
            for step in range(1, order.shape[1]):
                offset = order[:, step]
                term = windows.rows[window, offset]
                keep = np.flatnonzero((term < 0) | self.has(np.maximum(term, 0), start + offset))
                window, order, start = window[keep], order[keep], start[keep]
            doc = self.doc_of(start)
            keep = start + windows.sizes[window] <= self.first[doc] + self.n_words[doc]
            out.append((window[keep], start[keep]))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])

    def near(self, windows: Windows, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Window and document where some ``reach`` consecutive words hold every word of the window, in any order.

        Around a place of the rarest term, each bit of a mask is one such stretch; a term
        leaves the bits of the stretches in which it stands.
        """
        out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        full = (1 << reach) - 1
        for window, order, place in self.anchors(windows):
            doc = self.doc_of(place)
            low = np.maximum(place - reach + 1, self.first[doc])
            high = np.minimum(place + reach, self.first[doc] + self.n_words[doc])
            mask = np.full(len(place), full, dtype=np.int64)
            for step in range(1, order.shape[1]):
                term = windows.rows[window, order[:, step]]
                there = np.maximum(term, 0) << 32
                at, end = np.searchsorted(self.keys, there | low), np.searchsorted(self.keys, there | high)
                held = np.where(term < 0, full, 0)
                more = np.flatnonzero((at < end) & (term >= 0))
                while len(more):
                    apart = self.places[at[more]] - place[more]
                    ahead = full & ~((1 << np.maximum(apart, 0)) - 1)
                    behind = (1 << (reach - np.maximum(-apart, 0))) - 1
                    held[more] |= np.where(apart >= 0, ahead, behind)
                    at[more] += 1
                    more = more[at[more] < end[more]]
                mask &= held
                keep = np.flatnonzero(mask)
                window, order, place, doc = window[keep], order[keep], place[keep], doc[keep]
                low, high, mask = low[keep], high[keep], mask[keep]
            out.append((window, doc))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _names(window: np.ndarray, doc: np.ndarray, windows: Windows, n_docs: int) -> list[list[str]]:
    """Items per document from pairs of window and document."""
    names: list[set[str]] = [set() for _ in range(n_docs)]
    for pair in np.unique(doc * len(windows.rows) + window).tolist():
        names[pair // len(windows.rows)].update(windows.items[pair % len(windows.rows)])
    return [sorted(n) for n in names]


_FOUND = "block long, number int, doc_id long, n_words int, spans array<struct<begin:int,end:int>>, items array<string>, near array<string>"


def _spans(starts: np.ndarray, sizes: np.ndarray, block: Block) -> list[list[dict]]:
    """Stretches of words inside any occurrence, from the document's first word on, per document."""
    cover = np.zeros(int((block.first + block.n_words).max(initial=0)) + 1, dtype=np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + sizes, -1)
    hit = np.flatnonzero(np.cumsum(cover) > 0)
    doc = block.doc_of(hit)
    opens = np.flatnonzero((np.diff(hit, prepend=-2) > 1) | (np.diff(doc, prepend=-1) > 0))
    closes = np.append(opens[1:], len(hit))[: len(opens)] - 1
    spans: list[list[dict]] = [[] for _ in block.first]
    inside = hit - block.first[doc]
    for d, begin, end in zip(doc[opens].tolist(), inside[opens].tolist(), inside[closes].tolist(), strict=True):
        spans[d].append({"begin": begin, "end": end + 1})
    return spans


_FOUND = (
    "block long, number int, doc_id long, n_words int, "
    "spans array<struct<begin:int,end:int>>, items array<string>, near array<string>"
)


def _searched(windows, reach: int | None) -> Callable[[pa.Table], pa.Table]:
    """What a task does with a block; ``windows`` is a broadcast variable."""

    def run(table: pa.Table) -> pa.Table:
        asked = windows.value
        block = Block(table, asked.terms)
        count = len(block.first)
        window, start = block.phrases(asked)
        items = _names(window, block.doc_of(start), asked, count)
        near = _names(*block.near(asked, reach), asked, count) if reach else [[] for _ in items]
        names = pa.list_(pa.string())
        spans = _spans(start, asked.sizes[window], block)
        found = [pa.array(spans, pa.list_(pa.struct({"begin": pa.int32(), "end": pa.int32()}.items())))]
        found += [pa.array(items, names), pa.array(near, names)]
        return pa.table(
            [*(block.docs.column(c) for c in ("block", "number", "doc_id", "n_words")), *found],
            names=["block", "number", "doc_id", "n_words", "spans", "items", "near"],
        )

    return run


def search(
    index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", width: int = WIDTH, reach: int | None = None
) -> DataFrame:
    """Phrase and proximity matches of ``items`` in an index, one row per document.

    ``spans`` are the stretches of a document's words inside any occurrence of a window
    (``width`` consecutive words of an item, or a shorter item whole), ``items`` the ids,
    as strings in order, whose windows occur. ``near`` has the ids of which a window's
    words all stand, in any order, within some ``reach`` (at most 62) consecutive words
    of the document; empty without ``reach``. Items of any number are searched, cut into
    chunks of about ``ITEM_WORDS`` words that are sent to the tasks one after another.
    """
    spark = index.sparkSession
    segments = store(item_segments(items, key, text, width), "segments")
    total = segments.agg(F.sum(F.size("words"))).first()[0] or 0
    chunks = max(1, -(-total // ITEM_WORDS))
    found = []
    for chunk in range(chunks):
        part = segments.filter(F.pmod(F.xxhash64("item", "words"), F.lit(chunks)) == chunk)
        asked = spark.sparkContext.broadcast(windows_of(part.collect(), width))
        terms = store(part.select(F.explode("words").alias("term")).distinct(), "terms")
        rows = index.filter("term is not null").join(terms, "term", "left_semi").select(index.columns)
        rows = rows.unionByName(index.filter("term is null"))
        found.append(rows.groupBy("block").applyInArrow(_searched(asked, reach), _FOUND))
    if chunks == 1:
        return found[0]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("block", "number").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        _joined("spans"),
        F.array_distinct(_joined("items")).alias("items"),
        F.array_distinct(_joined("near")).alias("near"),
    )


def _joined(name: str) -> Column:
    return F.array_sort(F.flatten(F.collect_list(name))).alias(name)


def covered(spans: Column) -> Column:
    """Words inside sorted spans that may overlap, each counted once."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("upto"))

    def add(seen: Column, span: Column) -> Column:
        fresh = F.greatest(F.lit(0), span["end"] - F.greatest(span["begin"], seen["upto"]))
        return F.struct((seen["words"] + fresh).alias("words"), F.greatest(seen["upto"], span["end"]).alias("upto"))

    return F.aggregate(spans, start, add, lambda seen: seen["words"])


def contamination(docs: DataFrame, items: DataFrame, path: str, width: int = WIDTH, reach: int | None = None) -> DataFrame:
    """Index ``docs`` at ``path``, a new folder, and report every document against the items.

    One row per document row: ``doc_id``, ``n_words``, ``n_hit`` (words inside any window's
    occurrence), ``n_items`` and ``items_sha256`` (the ids whose windows occur, as strings
    in order, joined by commas), ``contaminated``, ``n_near`` (items with a near match).
    A document or item with null or empty text or without words matches nothing.
    """
    write_index(docs, path)
    index = docs.sparkSession.read.schema(INDEX).parquet(path)
    return search(index, items, width=width, reach=reach).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS gram
  FROM items WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS spot,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS gram
  FROM docs, sizes WHERE len(w) >= n
),
found AS (SELECT rid, spot, n, item FROM grams JOIN windows USING (n, gram)),
hit AS (
  SELECT rid, count(DISTINCT place) AS n_hit
  FROM (SELECT rid, unnest(range(spot, spot + n)) AS place FROM (SELECT DISTINCT rid, spot, n FROM found)) GROUP BY rid
),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""
"""The same in SQL, without ``n_near``."""
