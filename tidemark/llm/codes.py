"""Vector code compression with integer arithmetic alone.

A vector becomes integers and is cut into parts; each part position has a codebook, and a
part is stored as the number of its nearest entry. Distances are found in the integer
Walsh-Hadamard domain: a part and an entry, padded with zeros to a power of two, differ
there by the same squared distance times that power. The transform gathers most of the
difference in the smooth functions, so the squares are added in order of sequency and an
entry is given up as soon as its sum passes that of a known one. Nothing is rounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.names import spare
from tidemark.session import store

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 62
LONG = (1 << 63) - 1


@dataclass
class Codebooks:
    """Entries as Python integers or 64-bit ones: part position, entry, place within the part."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Digest of all components as decimal text, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.reshape(-1)).encode()).hexdigest()


def sequency_order(size: int) -> np.ndarray:
    """Where the function with 0, 1, 2, ... sign changes lies in a transform of natural order: bits of the Gray code, reversed."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    out = np.zeros(size, dtype=np.int64)
    for bit in range(bits):
        out |= ((gray >> bit) & 1) << (bits - 1 - bit)
    return out


def transformed(rows: np.ndarray) -> np.ndarray:
    """The integer Walsh-Hadamard transform of the last axis, padded to a power of two, in order of sequency."""
    width = rows.shape[-1]
    size = 1 << max(width - 1, 0).bit_length()
    out = np.zeros((*rows.shape[:-1], size), dtype=rows.dtype)
    out[..., :width] = rows
    step = 1
    while step < size:
        pairs = out.reshape(*rows.shape[:-1], size // (2 * step), 2, step)
        left, right = pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]
        out = np.stack([left, right], axis=-2).reshape(*rows.shape[:-1], size)
        step *= 2
    return out[..., sequency_order(size)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry of each point, ties to the lower, and the squared distance.

    Both are transformed; the squares of coefficients are added from the lowest sequency
    on. The entry that is best by the first one sets a bound; of the others only those
    stay in the list that have not passed it.
    """
    size = points.shape[1]
    partial = (points[:, :1] - entries[:, 0]) ** 2
    guess = partial.argmin(axis=1)
    bound = ((points - entries[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    total = partial[row, entry]
    for place in range(1, size):
        total = total + (points[row, place] - entries[entry, place]) ** 2
        alive = total <= bound[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    begins = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(total, begins) if len(begins) else total
    best = np.flatnonzero(total == least[row])
    best = best[np.diff(row[best], prepend=-1) > 0]
    return entry[best], total[best] // size


def integers(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, list | np.ndarray, int]:
    """Rows that are kept, their components as integers, and the greatest length among them.

    A row is kept unless it is null or holds a null, an infinity or no number. ``dims``
    pads shorter rows with zeros; without it the rows come as lists.
    """
    if not len(column):
        return np.empty(0, np.int64), [] if dims is None else np.zeros((0, dims), np.int64), 0
    lists = column.cast(pa.large_list(pa.float64()))
    there = np.asarray(lists.is_valid())
    flat = lists.values
    at = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset : lists.offset + len(lists) + 1]
    x = flat.to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    kept = np.flatnonzero(there & (bad[at[1:]] == bad[at[:-1]]))
    sizes = (at[1:] - at[:-1])[kept]
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.floor(x * SCALE), -LARGEST, LARGEST)
        whole = np.where(np.isnan(whole), 0, whole).astype(np.int64)
    longest = int(sizes.max(initial=0))
    if dims is None:
        return kept, [whole[at[i] : at[i + 1]].tolist() for i in kept], longest
    out = np.zeros((len(kept), dims), dtype=np.int64)
    if len(kept):
        inside = np.arange(dims) < sizes[:, None]
        source = np.minimum(at[kept][:, None] + np.arange(dims), max(len(whole) - 1, 0))
        out[inside] = whole[source[inside]]
    return kept, out, longest


def _safe(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python integers where sums of squares could pass 64 bits; else as they are."""
    width = max(rows.shape[-1], 1)
    size = 1 << max(width - 1, 0).bit_length()
    top = max((max(abs(int(a.max())), abs(int(a.min()))) for a in (rows, entries) if a.size), default=0)
    if size * (2 * size * top) ** 2 <= LONG:
        return rows.astype(np.int64), entries.astype(np.int64)
    return rows.astype(object), entries.astype(object)


def assigned(rows: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and squared distances of all parts: one row a vector, one column a part."""
    parts, _, width = books.entries.shape
    rows, entries = _safe(rows, books.entries)
    points = transformed(rows.reshape(len(rows), parts, width))
    entries = transformed(entries)
    found = [nearest(points[:, part], entries[part]) for part in range(parts)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def first_vectors(vectors: DataFrame, key: str, vec: str, entries: int) -> tuple[list[list[int]], int]:
    """Vectors of the smallest kept ids, ascending, and the greatest length of all kept vectors.

    A task passes on no more than ``entries`` ids; of several vectors of one id the
    smallest counts, and a null id comes last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict = {}
        longest = -1
        for batch in batches:
            kept, rows, length = integers(batch.column("vec"))
            if not len(kept):
                continue
            longest = max(longest, length)
            for name, row in zip(batch.column("id").take(pa.array(kept)).to_pylist(), rows, strict=True):
                least[name] = min(least.get(name, row), row)
            if len(least) > 64 * entries:
                least = {n: least[n] for n in sorted(least, key=_null_last)[:entries]}
        if longest >= 0:
            names = sorted(least, key=_null_last)[:entries]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(names, pa.int64()),
                    "row": pa.array([least[n] for n in names], pa.list_(pa.int64())),
                    "longest": pa.array([longest] * len(names), pa.int32()),
                }
            )

    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vec).alias("vec"))
    found = store(rows.mapInArrow(run, "id long, row array<long>, longest int"), "first-vectors")
    longest = found.agg(F.max("longest")).first()[0]
    first = found.groupBy("id").agg(F.min("row").alias("row")).orderBy(F.asc_nulls_last("id")).limit(entries)
    return [r.row for r in first.collect()], longest or 0


def _null_last(name: int | None) -> tuple[bool, int]:
    return name is None, name or 0


def _sums(vectors: DataFrame, vec: str, books: Codebooks) -> dict[int, int]:
    """Counts and component sums of what each entry is nearest to, over all rows, by number of the sum.

    A task adds up its rows; Spark adds the tasks, so the driver receives one model's worth.
    """
    parts, k, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, width + 1), dtype=object)
        for batch in batches:
            _, rows, _ = integers(batch.column("vec"), parts * width)
            if not len(rows):
                continue
            codes, _ = assigned(rows, books)
            wide = abs(rows).max(initial=0) > LONG // max(len(rows), 1)
            part_sums = np.zeros((parts, k, width + 1), dtype=object if wide else np.int64)
            cut = rows.reshape(len(rows), parts, width)
            for part in range(parts):
                np.add.at(part_sums[part, :, :width], codes[:, part], cut[:, part].astype(part_sums.dtype))
                part_sums[part, :, width] = np.bincount(codes[:, part], minlength=k)
            total = total + part_sums
        flat = total.reshape(-1)
        used = [i for i, value in enumerate(flat) if value]
        yield pa.RecordBatch.from_pydict(
            {"slot": pa.array(used, pa.int32()), "value": pa.array([str(flat[i]) for i in used], pa.string())}
        )

    sums = vectors.select(F.col(vec).alias("vec")).mapInArrow(run, "slot int, value string")
    sums = sums.groupBy("slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return {r.slot: int(r.value) for r in sums.collect()}


def fit(
    vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks that start as the parts of the vectors with the smallest ids and are moved to the floor of their parts' mean.

    An entry that no part is nearest to stays. Fewer vectors than ``entries`` give fewer
    entries, an empty table none. Vectors shorter than the longest, or than a multiple
    of ``parts``, count as if zeros followed. All rows take part in each round.
    """
    first, longest = first_vectors(vectors, key, vec, entries)
    width = -(-longest // parts)
    start = np.zeros((len(first), parts * width), dtype=np.int64)
    for row, vector in zip(start, first, strict=True):
        row[: len(vector)] = vector
    books = Codebooks(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    if not first or not width:
        return books
    for _ in range(rounds):
        sums = _sums(vectors, vec, books)
        moved = books.entries.astype(object)
        for part in range(parts):
            for entry in range(len(first)):
                slot = (part * len(first) + entry) * (width + 1)
                count = sums.get(slot + width, 0)
                if count:
                    moved[part, entry] = [sums.get(slot + place, 0) // count for place in range(width)]
        books = Codebooks(moved.astype(np.int64))
    return books


def compressed(vectors: DataFrame, books: Codebooks, vec: str = "embedding") -> DataFrame:
    """All columns of the kept rows but the vector, and ``code`` (entry numbers in part order) and ``error``.

    ``error`` is the squared distance to the entries summed over the parts, null where it
    does not fit a long. Rows whose vector is null or holds a null or non-finite
    component are dropped. Components count up to 2**62 once scaled.
    """
    rest = [c for c in vectors.columns if c != vec]
    code, error = spare(vectors, "code", "error")
    parts, k, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows, _ = integers(batch.column(batch.num_columns - 1), parts * width)
            if not len(kept):
                continue
            if k and width:
                codes, far = assigned(rows, books)
                far = [v if v <= LONG else None for v in far.astype(object).sum(axis=1).tolist()]
            else:
                codes, far = np.zeros((len(kept), parts), np.int64), [0] * len(kept)
            ends = pa.array(np.arange(len(kept) + 1, dtype=np.int32) * parts)
            out = [batch.column(i).take(pa.array(kept)) for i in range(batch.num_columns - 1)]
            out += [pa.ListArray.from_arrays(ends, pa.array(codes.reshape(-1).astype(np.int32))), pa.array(far, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, names=[*rest, code, error])

    rows = vectors.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{vec}`").alias(spare(vectors, "_vec")[0]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    kinds = f"{kinds}, " if kinds else ""
    return rows.mapInArrow(run, f"{kinds}`{code}` array<int>, `{error}` long")


def coded_rows(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: ``vec_id``, ``code`` as hex digits, ``error``, ``label_error`` and the codebooks' digest.

    ``label_error`` is the sum of errors over equal labels, null labels together, and
    null where it does not fit a long. Repeated rows and ids stay rows of their own.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    books = fit(rows)
    coded = store(compressed(rows, books), "codes")
    whole = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(whole.alias("_sum"))
    sums = store(sums, "label-errors")
    digits = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id",
        digits.alias("code"),
        "error",
        F.col("_sum").try_cast("long").alias("label_error"),
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


SQL = """
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
width AS (SELECT (max(len(v)) // 16)::BIGINT AS w FROM kept),
parts AS (SELECT rid, p, v[p * w + 1 : p * w + w] AS x FROM kept, width, range(16) t(p)),
seeds AS (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
book0 AS (SELECT p, e, x AS c FROM seeds JOIN parts USING (rid)),
ROUNDS
last AS (
  SELECT rid, p, min((d, e)) AS best
  FROM (SELECT rid, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts JOIN book2 USING (p))
  GROUP BY rid, p
),
coded AS (
  SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
  FROM last GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (rid)
""".replace(
    "ROUNDS",
    "".join(
        f"""
near{k} AS (
  SELECT rid, p, min((d, e))[2] AS e
  FROM (SELECT rid, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts JOIN book{k - 1} USING (p))
  GROUP BY rid, p
),
mean{k} AS (
  SELECT p, e, list(floor_of ORDER BY i) AS c
  FROM (SELECT p, e, i, (sum(s) - ((sum(s) % count(*)) + count(*)) % count(*)) // count(*) AS floor_of
        FROM (SELECT p, e, unnest(x)::HUGEINT AS s, generate_subscripts(x, 1) AS i FROM near{k} JOIN parts USING (rid, p))
        GROUP BY p, e, i)
  GROUP BY p, e
),
book{k} AS (
  SELECT p, e, coalesce(m.c::BIGINT[], b.c) AS c FROM book{k - 1} b LEFT JOIN mean{k} m USING (p, e)
),"""
        for k in (1, 2)
    ),
)
"""The same in SQL, for tables whose vectors have one length, a multiple of 16, and distinct ids."""
