"""Near-duplicate vectors by a forest of random-projection trees with spill."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import store

TREES = 4
LEAF = 256
SLACK = 4
SPILL = 1.25
STUCK = 0.8
CHUNK = 1024
COPIES = 1  # of all vectors that are sent to their leaves in one round
_NODE = ["root", "tree", "node"]
_STATE = "at long, root long, tree int, node long, depth int, from_n long"
_SIDES = f"{_STATE}, levels int, dim int, side array<float>"


def usable(vector: str = "embedding") -> Column:
    """Whether a vector is non-null, without null or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _directions(seed: int, tree: int, first: int, levels: int, dim: int) -> np.ndarray:
    """Unit directions of a tree's levels; every level has one, drawn from the seed."""
    rows = [np.random.default_rng([seed, tree, level, dim]).standard_normal(dim) for level in range(first, first + levels)]
    return np.array([row / np.linalg.norm(row) for row in rows]).reshape(levels, dim)


def _units(column: pa.ChunkedArray, rows: np.ndarray, dim: int) -> np.ndarray:
    """Vectors of one length as unit rows."""
    unit = column.take(pa.array(rows)).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def _kinds(table: pa.Table, *names: str) -> Iterator[tuple[list[int], np.ndarray]]:
    """The different values of some columns, and the rows that have them."""
    kinds, kind = np.unique(np.stack([table[name].to_numpy() for name in names], axis=1), axis=0, return_inverse=True)
    for k, values in enumerate(kinds.tolist()):
        yield values, np.flatnonzero(kind.reshape(-1) == k)


def _sent(side: np.ndarray, node: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and nodes of rows after as many splits as ``side`` has columns; within the margin a row goes both ways."""
    place = np.arange(len(side))
    for level in range(side.shape[1]):
        value = side[place, level]
        low, high = value <= margin, value >= -margin
        node = np.concatenate([2 * node[low], 2 * node[high] + 1])
        place = np.concatenate([place[low], place[high]])
    return place, node


def _placed(table: pa.Table, rows: np.ndarray, node: np.ndarray, **changed) -> pa.Table:
    """State rows: some rows of a table in their new nodes."""
    out = table.select([c for c in ("at", "root", "tree", "depth", "from_n") if c in table.column_names]).take(pa.array(rows))
    for name, values in {"node": node, **changed}.items():
        if name in out.column_names:
            out = out.drop_columns(name)
        out = out.append_column(name, pa.array(values, pa.int64() if name == "node" else pa.int32()))
    return out.select(["at", "root", "tree", "node", "depth", "from_n"])


def _planted(reps: DataFrame, roots: DataFrame, trees: int, radius: float, seed: int) -> DataFrame:
    """Send all vectors down as many levels as their label's size asks for, in all trees.

    A row within the spill margin of a split goes to both sides. Splits pass through the
    mean of the label's vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            for (dim, levels), rows in _kinds(table, "dim", "levels"):
                mean = table["mean"].take(pa.array(rows)).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                shifted = _units(table["embedding"], rows, dim) - mean
                for tree in range(trees):
                    side = shifted @ _directions(seed, tree, 0, levels, dim).T
                    place, node = _sent(side, np.ones(len(rows), np.int64), SPILL * radius / math.sqrt(dim))
                    tags = {"tree": np.full(len(place), tree, np.int32), "depth": np.full(len(place), levels, np.int32)}
                    yield from _placed(table, rows[place], node, **tags).to_batches()

    columns = ["at", "root", "from_n", "dim", "levels", "mean", "embedding"]
    return reps.join(roots, ["label", "dim"]).select(*columns).mapInArrow(run, _STATE)


def _split(big: DataFrame, reps: DataFrame, radius: float, seed: int) -> DataFrame:
    """Send the rows of big nodes further down, as many levels as the size of each asks for.

    A split needs no more of a vector than its places along the node's directions, and of
    the node their means: the vectors are looked up once and go no further.
    """

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            for (dim, tree, depth, levels), rows in _kinds(table, "dim", "tree", "depth", "levels"):
                side = _units(table["embedding"], rows, dim) @ _directions(seed, tree, depth, levels, dim).T
                out = table.drop_columns("embedding").take(pa.array(rows))
                bounds = pa.array(np.arange(len(rows) + 1) * levels, pa.int32())
                out = out.append_column("side", pa.ListArray.from_arrays(bounds, pa.array(side.reshape(-1), pa.float32())))
                yield from out.to_batches()

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            for (dim, levels), rows in _kinds(table, "dim", "levels"):
                some = table.take(pa.array(rows))
                side, mean = (
                    some[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)[:, :levels].astype(np.float64)
                    for c in ("side", "mean")
                )
                place, node = _sent(side - mean, some["node"].to_numpy(), SPILL * radius / math.sqrt(dim))
                depth = (some["depth"].to_numpy() + levels)[place].astype(np.int32)
                yield from _placed(some, place, node, depth=depth).to_batches()

    columns = ["at", "root", "tree", "node", "depth", "from_n", "levels"]
    rows = big.select(*columns).join(reps.select("at", "dim", "embedding"), "at").select(*columns, "dim", "embedding")
    sides = store(rows.mapInArrow(along, _SIDES), "sides")
    most = sides.agg(F.max("levels")).first()[0]
    along_mean = F.array(*[F.coalesce(F.avg(F.get("side", F.lit(i))), F.lit(0.0)) for i in range(most)])
    means = sides.groupBy(*_NODE).agg(along_mean.alias("mean"))
    return sides.join(means, _NODE).select(*columns, "dim", "side", "mean").mapInArrow(down, _STATE)


def leaves(reps: DataFrame, dims: int, radius: float, trees: int = TREES, leaf: int = LEAF, seed: int = 0) -> DataFrame:
    """The leaves that hold each vector: a narrow row per vector, tree and leaf, named by ``root, tree, node``.

    ``reps`` has at, label, dim, embedding. Every node with more than ``SLACK *
    leaf`` rows is split to leaves of about ``leaf``, all trees and nodes at once; nodes
    that are still too big go round again about their own mean. A node that keeps more
    than ``STUCK`` of its origin cannot be told apart by splits and stays a leaf, to be
    compared in chunks. Vectors are not written with their leaves.
    """
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    means = [F.avg(F.get("embedding", F.lit(i)).cast("double") / F.col("norm")).alias(f"m{i}") for i in range(dims)]
    sizes = reps.withColumn("norm", norm).groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"), *means)
    levels = F.greatest(F.ceil(F.log2(F.col("n") / leaf)).cast("int"), F.lit(0))
    mean = F.slice(F.array(*[f"m{i}" for i in range(dims)]), F.lit(1), F.col("dim"))
    roots = store(
        sizes.select(
            "label", "dim", F.monotonically_increasing_id().alias("root"), levels.alias("levels"), F.col("n").alias("from_n"), mean.alias("mean")
        ),
        "roots",
    )
    state, done = store(_planted(reps, roots, trees, radius, seed), "forest"), None
    while True:
        nodes = store(state.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n"), F.max("from_n").alias("was")), "nodes")
        big = nodes.filter((F.col("n") > SLACK * leaf) & (F.col("n") < STUCK * F.col("was"))).select(
            *_NODE, levels.alias("levels"), F.col("n").alias("from_n")
        )
        if big.isEmpty():
            return state if done is None else done.unionByName(state)
        settled = state.join(big.select(*_NODE), _NODE, "left_anti")
        done = settled if done is None else done.unionByName(settled)
        state = store(_split(state.drop("from_n").join(big, _NODE), reps, radius, seed), "forest")


def _linked(vectors: DataFrame, cosine: float, round: int, rounds: int) -> DataFrame:
    """Per chunk pair of a leaf: link counts by vector (kind 0), and edges that join what is linked (kind 1).

    Vectors carry ``homes``, all their leaves with the sizes of these, so that a link is counted only in
    the smallest leaf that both ends share; no list of links is ever written. A round takes
    its share of the leaves, of large ones its share of the chunk pairs: only so many
    copies of the vectors are on their way at once.
    """
    turn = lambda *of: F.pmod(F.xxhash64(*of), F.lit(rounds)) == round
    mine = F.filter("homes", lambda h: (h["m"] > CHUNK) | turn(h["home"]))
    rows = vectors.select("rep", "copies", "embedding", "homes", F.explode(mine).alias("h")).select(
        "rep", "copies", "embedding", F.col("homes.home").alias("homes"), "h.home", "h.m"
    )
    parts = F.ceil(F.col("m") / CHUNK).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns(
        {"low": F.least("own", "other"), "high": F.greatest("own", "other")}
    )
    met = met.filter((F.col("m") <= CHUNK) | turn("home", "low", "high"))
    met = met.select("home", "low", "high", "own", "rep", "copies", "embedding", "homes")
    met = met.repartition("home", "low", "high").sortWithinPartitions("home", "low", "high")

    def compare(group: pd.DataFrame) -> pd.DataFrame | None:
        home, low, high = group["home"].iloc[0], group["low"].iloc[0], group["high"].iloc[0]
        raw = np.stack(group["embedding"].to_numpy()).astype(np.float64)
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        own, rep, copies = (group[c].to_numpy() for c in ("own", "rep", "copies"))
        first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
        near = unit[first] @ unit[second].T
        i, j = np.nonzero(near >= cosine - 1e-9)
        values = near[i, j]
        i, j = first[i], second[j]
        if low == high:
            once = i < j
            i, j, values = i[once], j[once], values[once]
        edge = np.flatnonzero(np.abs(values - cosine) <= 1e-9)
        if len(edge):
            a, b = raw[i[edge]], raw[j[edge]]
            exact = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
            keep = np.ones(len(i), dtype=bool)
            keep[edge] = exact >= cosine
            i, j = i[keep], j[keep]
        if not len(i):
            return None
        lists = group["homes"].to_numpy()
        width = max(map(len, lists))
        homes = np.full((len(lists), width), home, dtype=np.int64)  # padding never lies below this leaf
        for row, one in enumerate(lists):
            homes[row, : len(one)] = one
        counted = np.ones(len(i), dtype=bool)
        for at in range(0, len(i), 1 << 15):
            a, b = homes[i[at : at + (1 << 15)]], homes[j[at : at + (1 << 15)]]
            shared = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] < home)).any(axis=(1, 2))
            counted[at : at + (1 << 15)] = ~shared
        links = np.zeros(len(rep), dtype=np.int64)
        np.add.at(links, i[counted], copies[j[counted]])
        np.add.at(links, j[counted], copies[i[counted]])
        found = np.flatnonzero(links)
        root = np.arange(len(rep))
        while True:
            least = np.minimum(root[i], root[j])
            after = root.copy()
            np.minimum.at(after, i, least)
            np.minimum.at(after, j, least)
            after = after[after]
            if np.array_equal(after, root):
                break
            root = after
        tied = np.flatnonzero(root != np.arange(len(rep)))
        return pd.DataFrame(
            {
                "kind": np.repeat([0, 1], [len(found), len(tied)]).astype(np.int32),
                "a": np.concatenate([rep[found], rep[tied]]),
                "b": np.concatenate([links[found], rep[root[tied]]]),
            }
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            tags = held[["home", "low", "high"]].to_numpy()
            begins = np.concatenate([[0], np.flatnonzero((tags[1:] != tags[:-1]).any(axis=1)) + 1])
            for begin, end in zip(begins[:-1], begins[1:], strict=True):
                if (out := compare(held.iloc[begin:end])) is not None:
                    yield out
            held = held.iloc[begins[-1] :].reset_index(drop=True)
        if held is not None and len(held) and (out := compare(held)) is not None:
            yield out

    return met.mapInPandas(run, "kind int, a long, b long")


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    trees: int = TREES,
    seed: int = 0,
) -> DataFrame:
    """Links between vectors of one label whose cosine is ``cosine`` or more.

    Returns ``vec_id``, ``n_links`` (vectors linked directly), ``component_id`` (smallest
    id reachable) and ``kept`` (the id is the component's). Equal vectors of a label form
    a class whose members are all linked; one of each class goes through the forest. A
    pair is lost only where every tree puts a split between the two that neither lies
    close to: the margin is ``SPILL`` times the distance at the threshold over the square
    root of the dimension, which a pair's projected difference exceeds on both sides
    about once in a hundred splits that meet it at all, so four trees miss next to
    nothing. What is found is confirmed in double precision.

    Null, zero, null-holding and non-finite vectors and rows without a label have no
    links; their component is their id. Vectors of different lengths are never linked.
    Every row counts as a vector, also where rows or ids repeat. A null id takes part, and
    a class of null ids only has a null component. Other columns are ignored. An empty
    table gives no rows.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("embedding")
    )
    takes_part = F.coalesce(F.col("label").isNotNull() & usable(), F.lit(False))
    rows = rows.withColumns(
        {"used": takes_part, "dim": F.size("embedding"), "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), F.reverse("embedding"))}
    )
    whole, rows = rows, store(rows.drop("embedding"), "vectors")
    digest = ["label", "h1", "h2"]
    classes = (
        rows.filter("used")
        .groupBy(*digest)
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("dim").alias("dim"))
    )
    classes = store(classes, "classes")
    dims = classes.agg(F.max("dim")).first()[0]
    heads = whole.filter("used").drop("dim").join(
        classes.withColumnRenamed("rep", "vec_id"), [*digest, "vec_id"]
    ).dropDuplicates([*digest])
    reached = links = None
    if dims is not None:
        reps = store(
            heads.select(F.monotonically_increasing_id().alias("at"), "label", "dim", F.col("vec_id").alias("rep"), "copies", "embedding"),
            "reps",
        )
        radius = math.sqrt(2 - 2 * cosine)
        placed = store(leaves(reps, dims, radius, trees, seed=seed).select("at", F.xxhash64(*_NODE).alias("home")), "leaves")
        sizes = placed.groupBy("home").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        homes = placed.join(sizes, "home").groupBy("at").agg(F.collect_list(F.struct("home", "m")).alias("homes"))
        met = store(reps.join(homes, "at").select("rep", "copies", "embedding", "homes"), "homes")
        copies = F.aggregate("homes", F.lit(0).cast("long"), lambda s, h: s + F.ceil(h["m"] / CHUNK))
        total, n = met.agg(F.sum(copies), F.count(F.lit(1))).first()
        rounds = math.ceil(total / (COPIES * n)) if n else 0
        found = None
        for one in range(rounds):
            some = store(_linked(met, cosine, one, rounds), "vector-links")
            found = some if found is None else found.unionByName(some)
    if dims is not None and found is not None:
        reached = components(found.filter("kind = 1").select("a", "b"))
        reached = reached.select(F.col("node").alias("rep"), "component")
        links = found.filter("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
        classes = classes.join(reached, "rep", "left").join(links, "rep", "left")
    else:
        classes = classes.withColumns({"component": F.lit(None).cast("long"), "others": F.lit(None).cast("long")})
    named = classes.select(
        *digest,
        F.coalesce("component", "rep").alias("component"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.lit(True).alias("used"),
    )
    out = rows.select("vec_id", "used", *digest).join(named, [*digest, "used"], "left")
    component = F.when(F.col("used"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
