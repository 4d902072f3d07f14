"""Arrow columns as numpy views, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def utf8_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column laid end to end, and one offset more than rows; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    at = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(at):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds one row, or rows whose texts come to ``limit`` bytes at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8_view(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly (the finaliser of the splitmix generator)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def stream_of(seed: int, count: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit integers."""
    start = np.uint64(seed) + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(start)
