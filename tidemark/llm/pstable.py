"""Nearest neighbours by multiprobe p-stable hashing, ranked by exact distance."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import mixed, stream_of
from tidemark.llm.forest import usable
from tidemark.session import store

TABLES = 2
FUNCTIONS = 6
WIDTH = 1.8
SUCCESS = 0.8
SAMPLE = 4096
PART = 4096
LEAST = 0.002
CELLS = 1 << 16
_ERF = np.vectorize(math.erf)
_TASK = ["dim", "tab", "part", "salt"]


class _Hashing:
    """The hash functions of one vector length: projections on normal vectors, cut into equal widths."""

    def __init__(self, dim: int, width: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.lines = rng.standard_normal((TABLES, dim, FUNCTIONS))
        self.shifts = rng.random((TABLES, FUNCTIONS))
        self.width = width

    def places(self, rows: np.ndarray, tab: int) -> np.ndarray:
        """Projections in units of the width; their floors name the bucket."""
        return rows @ self.lines[tab] / self.width + self.shifts[tab]

    def bucket(self, cells: np.ndarray, tab: int) -> np.ndarray:
        parts = cells.astype(np.int64).view(np.uint64) * (stream_of(17 + tab, FUNCTIONS) | np.uint64(1))
        return mixed(parts.sum(axis=-1, dtype=np.uint64)).view(np.int64)

    def probes(self, place: np.ndarray, radius: float, tab: int, success: float) -> np.ndarray | None:
        """Buckets by estimated chance of holding a neighbour at ``radius``, until ``success`` is reached.

        The offset of such a neighbour is normal along every line, which gives each cell's
        chance. None where that takes too many cells, so that all rows must be seen.
        """
        sigma = radius / self.width
        cells, chances = [], []
        for value in place:
            reach = min(4 * sigma, 4096.0)
            steps = np.arange(math.floor(value - reach), math.floor(value + reach) + 2, dtype=np.float64)
            below = 0.5 * (1 + _ERF((steps - value) / (sigma * math.sqrt(2))))
            chance = np.diff(below)
            likely = chance >= LEAST
            cells.append(steps[:-1][likely])
            chances.append(chance[likely])
        if math.prod(map(len, cells)) > CELLS:
            return None
        joint = np.ones(1)
        for chance in chances:
            joint = (joint[:, None] * chance).reshape(-1)
        order = np.argsort(-joint, kind="stable")
        reached = np.cumsum(joint[order])
        if not len(reached) or reached[-1] < success:
            return None
        order = order[: int(np.searchsorted(reached, success)) + 1]
        index = np.unravel_index(order, tuple(map(len, cells)))
        return self.bucket(np.stack([own[i] for own, i in zip(cells, index, strict=True)], axis=1), tab)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _nearest(query: np.ndarray, rows: np.ndarray, ids: list, keep: int) -> list[tuple[float, int]]:
    """The ``keep`` smallest (distance, id) among rows that each stand for some ids."""
    rough = ((rows - query) ** 2).sum(axis=1)
    if len(rough) > keep:
        limit = np.partition(rough, keep - 1)[keep - 1]
        picked = np.flatnonzero(rough <= limit)
    else:
        picked = np.arange(len(rough))
    found = [(math.sqrt(rough[x]), one) for x in picked.tolist() for one in ids[x]]
    return sorted(found)[:keep]


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    success: float = SUCCESS,
    seed: int = 0,
) -> DataFrame:
    """The ``k`` nearest rows of every row that ``is_query`` names, by Euclidean distance.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` (the distance of the
    original vectors in double precision), ties to the smaller id, the query's own id left
    out. ``is_query`` is a condition on ``vec_id``.

    Every vector is put into one bucket of each of ``TABLES`` tables; a bucket is a cell of
    ``FUNCTIONS`` random projections. A query visits cells in the order of the chance that
    a neighbour at its expected distance lies there, until the chance reaches ``success``
    in each table. That distance, and the width of the cells, come from a sample of
    ``SAMPLE`` vectors taken by hash over the whole table. Candidates of all tables are
    ranked by exact distance. A query whose ``k``-th find lies beyond the distance it was
    aimed with visits the further cells that the distance of this find asks for. Queries
    whose distance spans too many cells, or that found fewer than they asked for, are
    compared with every row, in blocks.

    Equal vectors form a class that is stored once with its ``k + 1`` smallest ids, which is
    all that a result can need. Buckets are dealt into parts of about ``PART`` rows and
    larger ones are split, so a task holds one part while queries stream past it.

    Null, zero, null-holding and non-finite vectors take no part, and neither do rows with
    a null id. Vectors are compared with those of their own length only. Repeated rows of
    one id are one candidate. With fewer than ``k`` candidates all are returned; an empty
    table, or one without queries, gives no rows. Other columns are ignored.
    """
    keep = k + 1
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    rows = rows.filter(F.coalesce(F.col("vec_id").isNotNull() & usable(), F.lit(False))).withColumns(
        {
            "dim": F.size("embedding"),
            "h1": F.xxhash64("embedding"),
            "h2": F.xxhash64(F.lit(1), F.reverse("embedding")),
            "asks": F.coalesce(is_query, F.lit(False)),
        }
    )
    rows = store(rows, "vectors")
    classes = store(_classes(rows, keep), "classes")
    sample = classes.select("dim", "embedding").orderBy(F.xxhash64("h1", "h2"), "h1").limit(SAMPLE).toPandas()
    if sample.empty:
        return _ranked(rows, classes, k)
    counts = {r["dim"]: (r["n"], r["ids"]) for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids")).collect()}
    samples = {int(dim): np.stack(own.to_numpy()).astype(np.float64) for dim, own in sample.groupby("dim")["embedding"]}
    hashing = {dim: _Hashing(dim, _width(own, counts[dim][0], k), seed) for dim, own in samples.items()}
    parts = {dim: max(1, -(-n // PART)) for dim, (n, _) in counts.items()}

    placed = store(_placed(classes, hashing, parts), "placed")
    sizes = placed.groupBy("dim", "tab", "part").agg(F.ceil(F.count(F.lit(1)) / (2 * PART)).alias("salts"))
    sizes = store(sizes, "parts")
    asking = classes.join(rows.filter("asks").select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
    asking = store(_expecting(asking.select("dim", "h1", "h2", "embedding"), samples, counts, k), "queries")
    found = store(_searched(placed, sizes, _aimed(asking, hashing, parts, success), keep), "found")
    wanted = F.create_map(*[F.lit(x) for dim, (_, ids) in counts.items() for x in (dim, min(keep, ids))])
    order = Window.partitionBy("h1", "h2").orderBy("score", "vec_id")
    finds = found.dropDuplicates(["h1", "h2", "vec_id"]).withColumn("nth", F.row_number().over(order))
    reached = finds.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("nth") == keep, F.col("score"))).alias("reach"))
    short = F.coalesce("n", F.lit(0)) < wanted[F.col("dim")]
    beyond = F.coalesce(F.col("reach") > F.col("radius"), F.lit(False))
    again = asking.join(reached, ["h1", "h2"], "left").filter(short | beyond)
    again = store(again.select(*asking.columns, F.when(~short, F.col("reach")).alias("reach")), "again")
    if not again.isEmpty():
        found = found.unionByName(_searched(placed, sizes, _aimed(again, hashing, parts, success), keep))
    return _ranked(rows, found, k)


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector, with its smallest ids."""
    order = Window.partitionBy("h1", "h2").orderBy("vec_id", "asks")
    first = rows.dropDuplicates(["h1", "h2", "vec_id"]).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= keep)
    ids = first.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return first.filter("nth = 1").select("h1", "h2", "dim", "embedding").join(ids, ["h1", "h2"])


def _radii(queries: np.ndarray, sample: np.ndarray, total: int, k: int) -> np.ndarray:
    """Expected distance of the k-th neighbour: the rank that the sample's share gives it, 1 at least."""
    rank = max(1, round(k * len(sample) / total))
    out = np.empty(len(queries))
    for at in range(0, len(queries), 256):
        own = queries[at : at + 256]
        square = (own**2).sum(axis=1)[:, None] + (sample**2).sum(axis=1) - 2 * own @ sample.T
        square[square <= 1e-9 * (own**2).sum(axis=1)[:, None]] = np.inf  # the query itself
        nth = min(rank, len(sample)) - 1
        out[at : at + 256] = np.sqrt(np.partition(square, nth, axis=1)[:, nth])
    return out


def _width(sample: np.ndarray, total: int, k: int) -> float:
    radii = _radii(sample[:256], sample, total, k)
    radii = radii[np.isfinite(radii)]
    return WIDTH * float(np.median(radii)) if len(radii) else 1.0


def _placed(classes: DataFrame, hashing: dict, parts: dict) -> DataFrame:
    """Every class once per table, with its bucket and the part that holds the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                unit = _matrix(own.column("embedding"))
                for tab in range(TABLES):
                    if dim in hashing:
                        bucket = hashing[dim].bucket(np.floor(hashing[dim].places(unit, tab)), tab)
                    else:
                        bucket = np.zeros(len(unit), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            own.column("dim"),
                            pa.array(np.full(len(unit), tab, np.int32)),
                            pa.array((bucket % parts[dim]).astype(np.int32)),
                            pa.array(bucket),
                            own.column("ids"),
                            own.column("embedding"),
                        ],
                        names=["dim", "tab", "part", "bucket", "ids", "embedding"],
                    )

    kind = classes.schema["embedding"].dataType.simpleString()
    return classes.select("dim", "ids", "embedding").mapInArrow(
        run, f"dim int, tab int, part int, bucket long, ids array<long>, embedding {kind}"
    )


def _expecting(asking: DataFrame, samples: dict, counts: dict, k: int) -> DataFrame:
    """Every query with the ``radius`` it expects its neighbours in; null where nothing tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                radii = np.full(len(own), np.nan)
                if dim in samples:
                    radii = _radii(_matrix(own.column("embedding")), samples[dim], counts[dim][0], k)
                unknown = ~(np.isfinite(radii) & (radii > 0))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(radii, pa.float64(), mask=unknown)], names=[*own.schema.names, "radius"]
                )

    kind = asking.schema["embedding"].dataType.simpleString()
    return asking.mapInArrow(run, f"dim int, h1 long, h2 long, embedding {kind}, radius double")


def _aimed(asking: DataFrame, hashing: dict, parts: dict, success: float) -> DataFrame:
    """A row per query, table and part with the buckets to visit there; no list means all.

    Queries with a ``reach`` have searched at their ``radius`` and get the further buckets
    that their reach asks for; where it is null, all.
    """
    repeated = "reach" in asking.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                unit = _matrix(own.column("embedding"))
                where, tabs, part_of, lists = [], [], [], []
                radii = own.column("radius").to_pylist()
                reaches = own.column("reach").to_pylist() if repeated else radii
                if dim in hashing:
                    places = [hashing[dim].places(unit, tab) for tab in range(TABLES)]
                for row, (radius, reach) in enumerate(zip(radii, reaches, strict=True)):
                    visits = None
                    if radius is not None and reach is not None:
                        if repeated:
                            before = [hashing[dim].probes(places[t][row], radius, t, success) for t in range(TABLES)]
                            if any(v is None for v in before):
                                continue  # it has seen all rows
                        visits = [hashing[dim].probes(places[t][row], reach, t, success) for t in range(TABLES)]
                    if visits is None or any(v is None for v in visits):
                        for part in range(parts[dim]):
                            where.append(row)
                            tabs.append(0)
                            part_of.append(part)
                            lists.append(None)
                        continue
                    for tab, buckets in enumerate(visits):
                        if repeated:
                            buckets = np.setdiff1d(buckets, before[tab])
                        homes = buckets % parts[dim]
                        for part in np.unique(homes).tolist():
                            where.append(row)
                            tabs.append(tab)
                            part_of.append(part)
                            lists.append(buckets[homes == part])
                taken = own.take(pa.array(where, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        taken.column("dim"),
                        pa.array(tabs, pa.int32()),
                        pa.array(part_of, pa.int32()),
                        taken.column("h1"),
                        taken.column("h2"),
                        taken.column("embedding"),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=["dim", "tab", "part", "h1", "h2", "embedding", "buckets"],
                )

    kind = asking.schema["embedding"].dataType.simpleString()
    return asking.mapInArrow(
        run, f"dim int, tab int, part int, h1 long, h2 long, embedding {kind}, buckets array<long>"
    )


def _searched(placed: DataFrame, sizes: DataFrame, aimed: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest ids that each query finds in each part it visits."""
    spot = ["dim", "tab", "part"]
    held = placed.join(sizes, spot).withColumn("salt", F.pmod(F.xxhash64("ids"), "salts").cast("int"))
    none = F.lit(None)
    held = held.select(
        *_TASK, F.lit(0).alias("turn"), "bucket", "ids", "embedding",
        none.cast("long").alias("h1"), none.cast("long").alias("h2"), none.cast("array<long>").alias("buckets"),
    )
    sent = aimed.join(sizes, spot).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts").cast("int") - 1)))
    sent = sent.select(
        *_TASK, F.lit(1).alias("turn"), none.cast("long").alias("bucket"), none.cast("array<long>").alias("ids"),
        "embedding", "h1", "h2", "buckets",
    )
    both = held.unionByName(sent).repartition(*_TASK).sortWithinPartitions(*_TASK, "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows, buckets, ids = None, [], [], []
        known: tuple | None = None
        for batch in batches:
            tags = [batch.column(name).to_numpy() for name in _TASK]
            turns = batch.column("turn").to_numpy()
            own_ids, lists = batch.column("ids").to_pylist(), batch.column("buckets")
            vectors = batch.column("embedding")
            ends = vectors.offsets.to_numpy()
            flat = vectors.values.to_numpy(zero_copy_only=False)
            bucket_of = batch.column("bucket").to_pylist()
            h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
            out: list[tuple] = []
            for row, tag in enumerate(zip(*tags, strict=True)):
                one = flat[ends[row] : ends[row + 1]].astype(np.float64)
                if tag != task:
                    task, rows, buckets, ids, known = tag, [], [], [], None
                if turns[row] == 0:
                    rows.append(one)
                    buckets.append(bucket_of[row])
                    ids.append(own_ids[row])
                    continue
                if known is None:
                    order = np.argsort(np.array(buckets, dtype=np.int64), kind="stable")
                    known = (
                        np.array(buckets, dtype=np.int64)[order],
                        np.stack(rows)[order] if rows else np.empty((0, len(one))),
                        [ids[x] for x in order.tolist()],
                    )
                if lists[row].is_valid:
                    visit = lists[row].values.to_numpy()
                    low, high = np.searchsorted(known[0], visit, "left"), np.searchsorted(known[0], visit, "right")
                    seen = np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)] or [np.empty(0, int)])
                    if not len(seen):
                        continue
                    near = _nearest(one, known[1][seen], [known[2][x] for x in seen.tolist()], keep)
                else:
                    near = _nearest(one, known[1], known[2], keep)
                out += [(h1[row], h2[row], vec, score) for score, vec in near]
            columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["h1", "h2", "vec_id", "score"]
            )

    return both.mapInArrow(run, "h1 long, h2 long, vec_id long, score double")


def _ranked(rows: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Merge what the tables found, and give every query row its list without itself."""
    if "score" not in found.columns:  # nothing to search
        none = rows.limit(0)
        return none.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    near = Window.partitionBy("h1", "h2").orderBy("score", "vec_id")
    best = found.dropDuplicates(["h1", "h2", "vec_id"]).withColumn("nth", F.row_number().over(near))
    best = best.filter(F.col("nth") <= k + 1).drop("nth")
    asks = rows.filter("asks").select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    pairs = asks.join(best, ["h1", "h2"]).filter("vec_id <> query_id")
    own = Window.partitionBy("query_id", "h1", "h2").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
