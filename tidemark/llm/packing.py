"""Documents as token pieces, packed into sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices
from tidemark.llm.encoders import encoder
from tidemark.llm.names import spare
from tidemark.session import store

CAPACITY = 1024
GROUP = 1 << 15
LOOSE = 3


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Token pieces of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and ``ids``.

    A document is the ids of its whole text and ``end_id``. One that is longer than
    ``capacity`` is cut into pieces of that length, the first of which may be shorter.
    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers. A null text
    counts as empty and gives the end alone. ``with_ids=False`` leaves the ids out, which
    is all that packing needs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text"):
            rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, whole in enumerate(batch.column("text").to_pylist()):
                data = encode(whole) + end
                count = len(data) // 4
                cuts = [0, *range(count % capacity or capacity, count + 1, capacity)]
                for piece, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    own = data[4 * low : 4 * high]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(low)
                    lengths.append(high - low)
                    sums.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())),
                "piece": pa.array(pieces, pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
            if with_ids:
                at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece, placed longest first.

    A piece goes where the sum over gaps of the squared count of open sequences with that
    gap becomes smallest, a new sequence being one of the choices; ties go to the smallest
    gap. Sequences that end up with more than ``LOOSE`` free places are then emptied once
    and their pieces placed again by the same rule with a growing weight on small gaps,
    that is into the tightest gap that holds them.
    """
    order = np.argsort(-lengths, kind="stable")
    gap_of, where = _placed(lengths[order], capacity, squares=True)
    loose = gap_of[where] > LOOSE
    _, again = _placed(lengths[order][loose], capacity, squares=False)
    _, where[~loose] = np.unique(where[~loose], return_inverse=True)
    where[loose] = again + (where[~loose].max(initial=-1) + 1)
    sequence = np.empty(len(lengths), dtype=np.int64)
    sequence[order] = where
    by_sequence = np.argsort(sequence, kind="stable")
    sizes = lengths[by_sequence]
    ends = np.cumsum(sizes)
    opens = np.flatnonzero(np.diff(sequence[by_sequence], prepend=-1))
    offset = np.empty(len(lengths), dtype=np.int64)
    offset[by_sequence] = ends - sizes - np.repeat((ends - sizes)[opens], np.diff(opens, append=len(sizes)))
    return sequence, offset


def _placed(lengths: np.ndarray, capacity: int, squares: bool) -> tuple[np.ndarray, np.ndarray]:
    """Gap left in every sequence, and the sequence of every piece."""
    count = np.zeros(capacity + 1)
    count[0], count[capacity] = -0.5, 0.5  # a full sequence costs nothing, a new one leaves no gap behind
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []
    where = np.empty(len(lengths), dtype=np.int64)
    for k, size in enumerate(lengths.tolist()):
        there = count[size:]
        if squares:
            change = np.where(there > 0, count[: capacity - size + 1] - there, np.inf)
            gap = size + int(change.argmin())
        else:
            gap = size + int((there > 0).argmax())
        if gap == capacity:
            one = len(gaps)
            gaps.append(capacity)
        else:
            count[gap] -= 1
            one = open_at[gap].pop()
        gaps[one] = gap - size
        if gap > size:
            count[gap - size] += 1
            open_at[gap - size].append(one)
        where[k] = one
    return np.array(gaps, dtype=np.int64), where


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length`` of 1 to ``capacity``.

    A piece of full length is a sequence of its own. The others are dealt evenly into
    groups of about ``group`` pieces, whose number follows the corpus, and each group is
    packed by itself: a task holds one group, and what a group cannot fill is a small
    share of it. Other columns pass through, so ids can travel along or be joined later; the
    new columns replace any of their name. Pieces of null or unfit length are refused. The pieces
    should be a stored table, as they are counted first. No pieces give no rows.
    """
    fit = F.col("length").isNotNull() & F.col("length").between(1, capacity)
    pieces = pieces.drop("sequence_id", "offset")
    (own,) = spare(pieces, "_group")
    checked = pieces.withColumn(
        "length", F.when(fit, F.col("length")).otherwise(F.raise_error(F.lit("length outside 1 to capacity")))
    )
    full = F.col("length") == capacity
    groups = max(1, -(-checked.filter(~full).count() // group))
    row = F.monotonically_increasing_id()
    whole = checked.filter(full).withColumns({"sequence_id": -1 - row, "offset": F.lit(0).cast("long")})
    open_rows = checked.filter(~full).withColumn(own, F.pmod(row, F.lit(groups)))

    def place(rows: pa.Table) -> pa.Table:
        sequence, offset = sum_of_squares(rows["length"].to_numpy().astype(np.int64), capacity)
        sequence += rows[own].to_numpy().astype(np.int64) << 32
        rows = rows.drop_columns([own])
        return rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    placed = open_rows.groupBy(own).applyInArrow(place, whole.schema)
    return whole.unionByName(placed)


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int, with_ids: bool = True, **options) -> DataFrame:
    """Tokenise whole documents, cut the long ones and pack the pieces; see the two steps."""
    return pack(store(token_pieces(docs, tokenizer, end_id, with_ids=with_ids, **options), "pieces"))
