from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import catalog, minmax
from tidemark.llm.arrow import utf8_view
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if min(len(sets[a]), len(sets[b])) * 100 >= 75 * max(len(sets[a]), len(sets[b])) > 0:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(catalog.op5_minmax_dedup(spark, sf_dir)) == brute(rows)


def test_a_chain_of_edits_and_a_hot_group(docs_of):
    """Edits that lie within reach of each other only link by link, and thousands of copies."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows, words = [], base.copy()
    for i in range(40):
        rows.append((1000 - i, " ".join(words)))
        words[(i * 37) % 120] = f"new{i}"
    rows += [(2000 + i, "same text for every one of these documents here") for i in range(700)]
    rows += [(5000 + i, " ".join(rng.choice("abcdefgh") for _ in range(30))) for i in range(60)]
    assert got(minmax.near_duplicates(docs_of(*rows))) == brute(rows)


def test_pairs_across_components_of_a_bucket_are_found(docs_of, monkeypatch):
    """Copies of one text with edits of their own: many do not reach the smallest id, and chunks are small."""
    monkeypatch.setattr(minmax, "CHUNK", 8)
    rng = random.Random(5)
    base = [f"v{rng.randrange(900)}" for _ in range(150)]
    rows = []
    for i in range(90):
        words = base.copy()
        for _ in range(rng.randrange(2, 9)):
            words[rng.randrange(150)] = f"e{i}x{rng.randrange(99)}"
        rows.append((i, " ".join(words)))
    assert got(minmax.near_duplicates(docs_of(*rows))) == brute(rows)


def test_sampled_sets_of_long_texts(docs_of, monkeypatch):
    monkeypatch.setattr(minmax, "WHOLE", 64)
    rng = random.Random(6)
    base = [f"v{rng.randrange(900)}" for _ in range(400)]
    rows = []
    for i in range(40):
        words = base.copy()
        for _ in range(rng.randrange(4, 26)):
            words[rng.randrange(400)] = f"e{i}x{rng.randrange(99)}"
        rows.append((i, " ".join(words)))
    assert got(minmax.near_duplicates(docs_of(*rows))) == brute(rows)


def test_nulls_short_texts_and_repeats(docs_of, empty_docs):
    rows = [(9, None), (8, ""), (7, " \t\n"), (6, "One two"), (5, "one  TWO"), (4, "one"), (3, "a b c d e"), (2, "É x y z w q"), (1, "é x y z w q")]
    df = minmax.near_duplicates(docs_of(*rows))
    assert got(df) == brute(rows)
    assert got(df)[9] == (0, 9, True) and got(df)[6] == (1, 5, False) and got(df)[1] == (2, 1, True)
    again = minmax.near_duplicates(docs_of((3, "a b"), (3, "a b"), (None, "a b"), (None, None))).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in again) == [(-1, -1, True), (-1, 3, False), (3, 3, True), (3, 3, True)]
    assert minmax.near_duplicates(empty_docs).collect() == []


def test_texts_that_share_an_id_are_documents_of_their_own(docs_of):
    rng = random.Random(8)
    one, other = (" ".join(f"{c}{rng.randrange(900)}" for _ in range(80)) for c in "ab")
    rows = [(1, one), (1, other), (2, f"{one} more"), (3, f"{other} more"), (5, other.upper()), (5, one)]
    found = minmax.near_duplicates(docs_of(*rows)).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 1), (5, 1)}
    assert sum(r.chosen for r in found) == 2 and all(r.kept for r in found if r.chosen)
    apart = minmax.near_duplicates(docs_of((0, f"{other} more"), (1, one), (1, other), (4, one))).collect()
    assert sorted((r.doc_id, r.component_id, r.chosen) for r in apart) == [(0, 0, True), (1, 0, False), (1, 1, True), (4, 1, False)]
    alike = minmax.near_duplicates(docs_of((1, one), (1, one.upper()), (1, f"{one} more"), (1, one))).collect()
    assert {r.component_id for r in alike} == {1} and len({r.mark for r in alike if r.chosen}) == 1


def test_sketches_keep_whole_hashes_below_the_bound():
    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 4096, dtype=np.uint64))
    assert minmax._below(values, 0) is values
    for halvings in (1, 2, 5):
        assert minmax._below(values, halvings).tolist() == [v for v in values.tolist() if v < 2**64 >> halvings]


def test_shingles_of_a_very_long_text_and_of_sliced_columns():
    text = " ".join(f"w{i % 5000}" for i in range(200_000))
    column = pa.array(["skip", None, text, "a b c d e f", ""])[1:]
    sets, ends = shingle_sets(*utf8_view(column), 5)
    assert np.diff(ends).tolist() == [0, 5000, 2, 0]


def test_min_max_signatures_agree_with_the_similarity():
    rng = np.random.default_rng(0)
    shared, one, other = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (600, 200, 200))
    sets = [np.unique(np.concatenate([shared, x])) for x in (one, other)]
    ends = np.cumsum([0, len(sets[0]), len(sets[1])])
    a, b = minmax.signatures(np.concatenate(sets), ends, 400)
    assert (a == b).mean() == pytest.approx(0.6, abs=0.06)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(1, 61)} == {1} and {found[100 + i] for i in range(200)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
