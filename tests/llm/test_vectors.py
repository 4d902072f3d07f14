from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import catalog, forest, pstable

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, dim string, part int, ids int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, 1, "d", 2, 3) for i, v, l in rows], SCHEMA)


def links(rows, cosine=0.98):
    """Brute force over rows (id, vector, label): id to (links, component, kept)."""
    used = {i: (np.array(v, np.float32).astype(float), l) for i, v, l in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    near = {i: set() for i, _, _ in rows}
    for a, (x, p) in used.items():
        for b, (y, q) in used.items():
            if a != b and p == q and len(x) == len(y) and x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= cosine:
                near[a].add(b)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(near[i]), min(seen), min(seen) == i)
    return out


def got(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert got(catalog.op2_projection_forest(spark, sf_dir)) == links(rows)


def clustered(rng, centres, each, dim=16, spread=0.04):
    rows = []
    for c in range(centres):
        middle = rng.standard_normal(dim)
        for _ in range(each):
            rows.append((middle + spread * rng.standard_normal(dim) * np.linalg.norm(middle) / math.sqrt(dim)) * rng.uniform(0.1, 9))
    return [(i, np.float32(v).tolist(), i % 2) for i, v in enumerate(rows)]


def test_many_leaves_dense_balls_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(forest, "CHUNK", 48)
    monkeypatch.setattr(forest, "LEAF", 24)
    rng = np.random.default_rng(2)
    rows = clustered(rng, 30, 12) + [(1000 + i, v, l) for i, v, l in clustered(rng, 1, 150, spread=0.15)]
    monkeypatch.setattr(forest.leaves, "__defaults__", (4, 24, 0))
    assert got(forest.near_vectors(frame(spark, rows))) == links(rows)


def test_unusable_copied_and_odd_vectors(spark):
    rows = [
        (1, None, 0), (2, [0, 0], 0), (3, [1, None], 0), (4, [float("nan"), 1], 0), (5, [float("inf"), 1], 0), (6, [], 0),
        (7, [1, 1], None), (8, [1, 1], 0), (9, [1, 1], 0), (10, [2, 2], 0), (11, [1, 1], 1), (12, [1, 1, 0], 0), (13, [-1, -1], 0),
    ]
    assert got(forest.near_vectors(frame(spark, rows))) == links(rows)
    assert forest.near_vectors(frame(spark, [])).collect() == []
    assert got(forest.near_vectors(frame(spark, rows[:6]))) == links(rows[:6])
    twice = forest.near_vectors(frame(spark, [(5, [1, 2], 0), (5, [1, 2], 0)])).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in twice] == [(5, 1, 5, True)] * 2


def nearest(rows, k=10):
    used = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, x in used.items():
        if i % 100 == 0:
            found = sorted((float(np.sqrt(((y - x) ** 2).sum())), j) for j, y in used.items() if j != i and len(y) == len(x))
            out[i] = found[:k]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(found, wanted):
    assert set(found) == set(wanted) and all(len(found[i]) == len(wanted[i]) for i in wanted)
    for i in wanted:
        assert found[i] == sorted(found[i])
    hits = sum(len({v for _, v in found[i]} & {v for _, v in wanted[i]}) for i in wanted)
    return hits / sum(map(len, wanted.values()))


def every_100():
    return F.col("vec_id") % 100 == 0


def test_search_query_reaches_the_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert recall(lists(catalog.op6_multiprobe_search(spark, sf_dir)), nearest(rows)) >= 0.9


def test_search_in_parts_with_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(pstable, "PART", 200)
    rng = np.random.default_rng(4)
    rows = clustered(rng, 60, 25, dim=8, spread=0.3) + [(5000 + i, [1.0] * 8, 0) for i in range(400)]
    found, wanted = lists(pstable.nearest_neighbours(frame(spark, rows), every_100())), nearest(rows)
    assert recall(found, wanted) >= 0.9
    assert found[5000] == wanted[5000] and found[5300] == wanted[5300]  # copies: ties to the smaller id


def test_search_with_few_or_unusable_rows(spark):
    rows = [(0, [1, 2], 0), (100, [1, 2], 0), (3, None, 0), (4, [0, 0], 0), (5, [3, 4], None), (6, [1, None], 0), (200, [1, 1, 1], 0), (300, [float("nan"), 1], 0)]
    found = lists(pstable.nearest_neighbours(frame(spark, rows), every_100()))
    assert found == {i: x for i, x in nearest(rows).items() if x}
    assert pstable.nearest_neighbours(frame(spark, []), every_100()).collect() == []
    assert pstable.nearest_neighbours(frame(spark, [(1, [1, 2], 0)]), every_100()).collect() == []
    twice = lists(pstable.nearest_neighbours(frame(spark, [(0, [1, 2], 0), (0, [1, 2], 0), (7, [2, 2], 0), (7, [2, 2], 0)]), every_100()))
    assert twice == {0: [(1.0, 7)]}


def test_search_far_above_the_sample_with_small_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(pstable, "SAMPLE", 256)  # the share of a sample of 4,096 among 50,000
    monkeypatch.setattr(pstable, "PART", 1000)
    rng = np.random.default_rng(6)
    middles = rng.standard_normal((40, 32))
    rows = (middles[rng.integers(0, 40, 1500)] + 0.5 * rng.standard_normal((1500, 32))).tolist()
    for i in range(0, 1500, 15):
        copies = rows[i] + 1e-3 * rng.standard_normal((15, 32))
        rows += copies[: 5 + i % 11].tolist()
    order = rng.permutation(len(rows))
    rows = [(i, np.float32(rows[x]).tolist(), 0) for i, x in enumerate(order.tolist())]
    every_7 = F.col("vec_id") % 7 == 0
    found = lists(pstable.nearest_neighbours(frame(spark, rows), every_7))
    every = np.array([v for _, v, _ in rows])
    wanted = {}
    for i in range(0, len(rows), 7):
        apart = np.sqrt(((every - every[i]) ** 2).sum(axis=1))
        wanted[i] = sorted((d, j) for j, d in enumerate(apart.tolist()) if j != i)[:10]
    assert recall(found, wanted) >= 0.93


def test_vectors_are_not_written_with_their_leaves(spark, monkeypatch):
    """A vector stood in a table for each tree and spill copy, and all of them were on their way at once."""
    monkeypatch.setattr(forest.leaves, "__defaults__", (4, 24, 0))
    rng = np.random.default_rng(4)
    rows = clustered(rng, 60, 10) + [(2000 + i, v, l) for i, v, l in clustered(rng, 1, 300, spread=0.5)]
    written, moved, keep, linked = [], [], forest.store, forest._linked

    def counted(df, label):
        out = keep(df, label)
        if "embedding" in out.columns:
            written.append(out.count())
        return out

    def sent(*args):
        out = linked(*args)
        moved.append(args)
        return out

    monkeypatch.setattr(forest, "store", counted)
    monkeypatch.setattr(forest, "_linked", sent)
    assert got(forest.near_vectors(frame(spark, rows))) == links(rows)
    assert sum(written) <= 2 * len(rows) and len(moved) > 4


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before, setting = files(), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    df = session.store(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert not files() - before and df.count() == 7
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == setting
