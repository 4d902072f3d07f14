from __future__ import annotations

import corpus_pipeline
import pytest
from test_packing import check_packed, ids_of

from tidemark.llm import linetree, minmax, pu
from tidemark.session import store

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """What each stage got and gave, every result stored and read again."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], SF_DIR), "stage"))
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near-duplicates", "packing"]
    assert all(t.columns == tables[0].columns for t in tables[:4])


def test_each_stage_takes_effect(spark, tables):
    docs, good, fresh, single, _ = tables
    scores = pu.quality_scores(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
    assert set(rows(good)) == {r.doc_id for r in scores if r.predicted}
    cleaned = {r.doc_id: r for r in linetree.drop_recurring(good).collect()}
    assert rows(fresh) == {i: r.text for i, r in cleaned.items() if not r.n_dropped or r.text.strip()}
    assert all(r.n_chars == len(r.text) for r in fresh.collect())
    groups = minmax.near_duplicates(fresh).collect()
    assert set(rows(single)) == {r.doc_id for r in groups if r.kept}
    assert all(rows(single)[i] == rows(fresh)[i] for i in rows(single))


def test_the_last_stage_packs_all_that_is_left(tables):
    left = rows(tables[3])
    encoded = ids_of("byte_bpe_50k.json", [left[i] or "" for i in left])
    documents = {i: [*ids, 2] for i, ids in zip(left, encoded, strict=True)}
    packed = tables[4].collect()
    check_packed(packed, documents)
    assert all(r.ids == documents[r.doc_id][r.start : r.start + r.length] for r in packed)


def test_run_gives_the_same(spark, tables):
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).select(key).collect())) == sorted(map(tuple, tables[4].select(key).collect()))


def test_stages_on_empty_null_and_repeated_documents(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "x y z", "en", "s", 5), (3, "x y z", "en", "s", 5), (None, "x", "en", "s", 1)]
    docs = spark.createDataFrame(odd, schema)
    for given in (docs, docs.limit(0)):
        at = given
        for _, stage in corpus_pipeline.STAGES:
            at = store(stage(spark, at, SF_DIR), "stage")
        assert {r.doc_id for r in at.collect()} == ({1, 2, 3, None} if given is docs else set())
        assert at.groupBy("doc_id", "piece").count().filter("count > 1").isEmpty()


def test_near_duplicates_stage_judges_texts_that_share_an_id_apart(spark):
    """A text that resembles nothing stays, whatever else stands under its id; own columns of any name stay too."""
    one, other = (" ".join(f"{c}{i * 7 % 91}" for i in range(80)) for c in "ab")
    rows = [(0, f"{other} more", "keep"), (1, one, "keep"), (1, other, "copy"), (1, one, "keep"), (4, one, "copy"), (5, None, "keep"), (None, one, "keep")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _mark string")
    left = corpus_pipeline.one_of_a_kind(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(0, f"{other} more"), (1, one), (5, None), (None, one)], key=str)
    assert {r._mark for r in left.collect()} == {"keep"}
