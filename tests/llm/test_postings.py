from __future__ import annotations

import hashlib
import random
import re

import oracle
import pytest

from tidemark.llm import arrow, catalog, postings
from tidemark.session import new_folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, item string, term string, words int"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, width=10, reach=0):
    """Rows by trying every window at every place."""
    windows = []
    for name, text in items:
        w = words(text)
        windows += [("" if name is None else str(name), w[i : i + width]) for i in range(max(len(w) - width + 1, 1)) if w]
    out = []
    for doc, text in docs:
        w = words(text)
        hit, names, near = set(), set(), set()
        for name, window in windows:
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    names.add(name)
            if reach and any(set(window) <= set(w[at : at + reach]) for at in range(max(len(w) - reach + 1, 1))):
                near.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), digest, bool(hit), len(near)))
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    rows = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, term string, block int, number int")
    asked = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in postings.contamination(rows, asked, new_folder(spark, "p"), **options).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(25)] + ["Ünï", "42", "ñ"]

    def text(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    items = [(i, text(draw.randint(1, 30))) for i in range(12)]
    docs = [(i, text(draw.randint(0, 120))) for i in range(40)]
    docs += [(100 + i, f"{text(9)}. {t.upper()}!\n{text(5)}") for i, t in items]
    docs += [(200 + i, " ".join(draw.sample(t.split(), len(t.split())))) for i, t in items]
    return docs, items


def test_query_equals_sql(spark, sf_dir):
    df = catalog.op12_positional_index(spark, sf_dir)
    assert oracle.difference(df, oracle.connect(sf_dir), postings.SQL) is None


def test_phrases_and_near_matches_equal_all_places(spark, corpus):
    docs, items = corpus
    assert got(spark, docs, items, reach=20) == plain(docs, items, reach=20)
    assert got(spark, docs, items, width=3, reach=4) == plain(docs, items, width=3, reach=4)


def test_chunks_of_items_and_small_blocks_change_nothing(spark, corpus, monkeypatch):
    docs, items = corpus
    whole = got(spark, docs, items, reach=20)
    monkeypatch.setattr(postings, "ITEM_WORDS", 40)
    assert got(spark, docs, items, reach=20) == whole
    monkeypatch.setattr(postings, "SEGMENT_WORDS", 4)
    assert got(spark, docs, items, reach=20) == whole


def test_lists_of_candidates_may_be_cut_anywhere(corpus):
    import numpy as np
    import pyarrow as pa

    docs, items = corpus
    texts = pa.array([t for _, t in docs])
    terms, begins = postings.words_of(*arrow.utf8_view(texts), postings.WORD_BYTES)
    coded = terms.dictionary_encode()
    lists = [np.flatnonzero(np.asarray(coded.indices) == c) for c in range(len(coded.dictionary))]
    count, n = len(lists), len(docs)
    table = pa.table(
        {
            "block": pa.array([0] * (count + n)), "term": pa.concat_arrays([coded.dictionary, pa.nulls(n, pa.string())]),
            "gaps": pa.array([np.diff(x, prepend=0).tolist() for x in lists] + [None] * n, pa.list_(pa.int32())),
            "doc_id": pa.array([None] * count + [i for i, _ in docs]), "number": pa.array([None] * count + list(range(n))),
            "first": pa.array([None] * count + begins[:-1].tolist()), "n_words": pa.array([None] * count + np.diff(begins).tolist()),
        }
    )
    segments = [type("Row", (), {"item": str(i), "words": words(t)}) for i, t in items]
    windows = postings.windows_of(segments, 10)
    block = postings.Block(table, windows.terms)
    whole = sorted(zip(*map(np.ndarray.tolist, block.phrases(windows)), strict=True))
    before = postings.CANDIDATES
    try:
        postings.CANDIDATES = 7
        assert sorted(zip(*map(np.ndarray.tolist, block.phrases(windows)), strict=True)) == whole
    finally:
        postings.CANDIDATES = before
    assert whole


def test_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = [(1, None), (2, ""), (3, "?!"), (4, passage), (4, passage), (None, passage.replace(" ", "\x00-")), (5, passage[:-7])]
    docs += [(6, "two two two"), (7, f"{'zero ' * 30000}{passage}{' zero' * 30000}"), (8, "Émile émile"), (9, "eleven ONE")]
    items = [(1, None), (2, ""), (None, "two"), (10, passage), (9, passage), (9, "émile"), (3, "... eleven one")]
    assert got(spark, docs, items, reach=12) == plain(docs, items, reach=12)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b"), (2, None)], []), ([], [])])
def test_empty_tables(spark, docs, items):
    assert got(spark, docs, items, reach=5) == plain(docs, items, reach=5)


def test_no_match_reaches_into_the_next_document(spark):
    docs = [(1, "a b c d e"), (2, ""), (3, "f g h i j")]
    assert not any(r[5] for r in got(spark, docs, [(1, "a b c d e f g h i j"), (2, "e f")], reach=10))
