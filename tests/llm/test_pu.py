from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from tidemark.llm import catalog, pu
from tidemark.llm.arrow import utf8_view
from tidemark.llm.style import style

LABELS = "doc_id long, quality int, toxic int, x string"


def area(scores, labels):
    one, zero = scores[labels == 1], scores[labels == 0]
    return (one[:, None] > zero[None, :]).mean() + (one[:, None] == zero[None, :]).mean() / 2


def test_query_on_the_held_out_fold(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in catalog.op8_pu_quality(spark, sf_dir).collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if rows[r.doc_id].held_out]
    scores, wanted = np.array([rows[r.doc_id].score for r in labels]), np.array([r.quality for r in labels])
    assert area(scores, wanted) > 0.95
    assert ((scores >= 0.3) == wanted).mean() > 0.9 and (scores[wanted == 1] >= 0.3).all()


def test_labels_of_the_held_out_fold_are_not_used(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    changed = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - quality, quality) AS quality"
    )
    one, other = ({r.doc_id: r.score for r in pu.quality_scores(docs, x).collect()} for x in (labels, changed))
    assert all(abs(one[i] - other[i]) < 1e-9 for i in one)


def test_the_kept_documents_are_the_predicted_ones(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in pu.quality_scores(docs, labels).collect() if r.predicted}
    kept = pu.keep_good(docs, labels)
    assert kept.schema == docs.schema
    assert {r.doc_id: r.text for r in kept.collect()} == {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}


def test_nulls_repeats_and_missing_labels(spark, docs_of, empty_docs):
    docs = docs_of((1, None), (2, ""), (3, "word " * 40_000), (3, "a"), (None, "b"))
    none = spark.createDataFrame([], LABELS)
    rows = pu.quality_scores(docs, none).collect()
    assert sorted(r.score for r in rows) == [0.5] * 5
    some = spark.createDataFrame([(1, 1, 0, ""), (1, 0, 0, ""), (3, 1, None, ""), (None, 1, 0, ""), (4, None, 0, "")], LABELS)
    rows = pu.quality_scores(docs, some).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert pu.quality_scores(empty_docs, some).collect() == []
    assert pu.keep_good(docs, none).count() == 5 and pu.keep_good(empty_docs, some).collect() == []


def test_the_fit_lowers_the_non_negative_risk(spark):
    """Against a plain gradient descent on the same risk."""
    rng = np.random.default_rng(0)
    raw = rng.random((400, pu.WIDTH)).astype(np.float32)
    role = np.where(np.arange(400) < 100, pu.POSITIVE, pu.UNLABELLED)
    raw[role == pu.POSITIVE, 0] += 0.5
    raw[(role == pu.UNLABELLED) & (np.arange(400) % 3 > 0), 0] += 0.5
    rows = spark.createDataFrame([(x.tolist(), int(r)) for x, r in zip(raw, role, strict=True)], "x array<float>, role int")
    model = pu.fit(rows, 0.66)
    x = model.inputs(raw)
    own, rest = x[role == pu.POSITIVE], x[role == pu.UNLABELLED]

    def risk(w):
        negative = np.logaddexp(0, rest @ w).mean() - 0.66 * np.logaddexp(0, own @ w).mean()
        return 0.66 * np.logaddexp(0, -own @ w).mean() + max(negative, -pu.SLACK) + pu.RIDGE / 2 * w @ w

    w = np.zeros(x.shape[1])
    for _ in range(4000):
        score = 1 / (1 + np.exp(-rest @ w))
        w -= 0.02 * (-0.66 * own.mean(0) + (score[:, None] * rest).mean(0) + pu.RIDGE * w)
    assert risk(model.weights) <= risk(w) + 1e-3


def test_style_of_sliced_and_empty_texts():
    column = pa.array(["zz", "", "Ab 1.\nc c", None])[1:]
    numbers = style(*utf8_view(column))
    assert numbers.shape == (3, pu.WIDTH) and not numbers[0].any() and not numbers[2].any()
    assert np.allclose(numbers[1], style(*utf8_view(pa.array(["Ab 1.\nc c"])))[0]) and numbers[1].any()
