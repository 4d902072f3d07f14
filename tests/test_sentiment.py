"""Scoring, summaries and profiles against hand-computed and numpy values."""

from __future__ import annotations


import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import sentiment as st
from tidemark.sources import readers

LEXICON = {"good": 8.0, "bad": 2.0, "fine": 6.5, "meh": 3.5}
POSTS = [
    # id, batchtime, first_term, text
    (1, 0, "a", "good good bad"),
    (2, 0, "a", "fine"),
    (3, 0, "a", "nothing scored here"),
    (4, 0, "b", "bad"),
    (5, 30, "a", "good"),
    (6, 30, "a", "good"),
    (7, 30, "c", ""),
    (8, 60, "a", "fine fine"),
    (9, 60, "a", "fine"),
]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "word STRING, score DOUBLE")


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(POSTS, "id LONG, batchtime LONG, first_term STRING, text STRING")


def pooled(batch, entity):
    return [LEXICON[w] for _, b, e, t in POSTS if (b, e) == (batch, entity) for w in t.split() if w in LEXICON]


def test_lexicon_edges(spark):
    scores = {"four": 4.0, "six": 6.0, "near4": 4.01, "near6": 5.99, "low": 0.99, "high": 9.01, "one": 1.0, "nine": 9.0}
    df = spark.createDataFrame(list(scores.items()), "word STRING, score DOUBLE")
    kept = {r.word for r in readers.neutral_removed(df).collect()}
    assert kept == {"four", "six", "one", "nine"}


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text('word\trank\tscore\tstd\n"laughter"\t1\t8.50\t0.9\nthe\t2\t4.98\t1\n"don\'t"\t3\t3.1\t1\n')
    rows = {r.word: r.score for r in readers.load_lexicon(spark, str(path)).collect()}
    assert rows == {"laughter": 8.5, "don't": 3.1}


def test_score_posts(spark, posts, lexicon):
    rows = {r.id: r for r in st.score_posts(posts, lexicon).collect()}
    assert rows[1].score_avg == pytest.approx(6.0)
    assert rows[1].score_std == pytest.approx(np.std([8, 8, 2]))
    assert (rows[3].score_avg, rows[3].words_used, rows[3].total_word_ct) == (None, 0, 3)
    assert (rows[7].total_word_ct, rows[7].prop_words_used) == (1, 0.0)
    assert st.scored_only(st.score_posts(posts, lexicon)).count() == 7


def test_summary_is_token_weighted(spark, posts, lexicon):
    rows = {(r.batchtime, r.first_term): r for r in st.finish_summary(st.partial_summary(posts, lexicon)).collect()}
    for key in {(b, e) for _, b, e, _ in POSTS}:
        scores = pooled(*key)
        if scores:
            assert rows[key].sentiment_avg == pytest.approx(np.mean(scores))
            assert rows[key].sentiment_std == pytest.approx(np.std(scores))
        else:
            assert rows[key].sentiment_avg is None and rows[key].sentiment_std is None
    assert rows[(0, "a")].num_posts == 3
    # equal scores have no spread at all, not a rounding remainder
    assert rows[(30, "a")].sentiment_std == 0.0 and rows[(60, "a")].sentiment_std == 0.0


def test_extremes(spark, posts, lexicon):
    rows = {(r.batchtime, r.first_term): r for r in st.extreme_posts(posts, lexicon).collect()}
    first = rows[(0, "a")]
    assert (first.high_id, first.high_text, first.low_id, first.low_text) == (2, "fine", 1, "good good bad")
    assert rows[(0, "b")].high_id is None  # one scored post is not enough
    assert (rows[(30, "a")].high_id, rows[(30, "a")].low_id) == (5, 5)  # a tie goes to the lowest id


def test_merging_any_split_of_the_posts_gives_the_same(spark, posts, lexicon):
    columns = ["batchtime", "first_term", "num_posts", "high_id", "high_text", "low_id", "low_text"]
    whole = st.finish_summary(st.partial_summary(posts, lexicon))
    halves = [posts.filter(F.col("id") % 2 == i) for i in (0, 1)]
    parts = st.partial_summary(halves[0], lexicon).unionByName(st.partial_summary(halves[1], lexicon))
    merged = st.finish_summary(st.merge_summaries(parts))
    assert sorted(map(tuple, merged.select(columns).collect()), key=str) == sorted(
        map(tuple, whole.select(columns).collect()), key=str
    )
    averages = {(r.batchtime, r.first_term): (r.sentiment_avg, r.sentiment_std) for r in whole.collect()}
    for r in merged.collect():
        expected = averages[(r.batchtime, r.first_term)]
        if expected[0] is not None:
            assert (r.sentiment_avg, r.sentiment_std) == pytest.approx(expected)


def test_a_repeated_post_counts_twice(spark, lexicon):
    twice = spark.createDataFrame([(1, 0, "a", "good bad")] * 2, "id LONG, batchtime LONG, first_term STRING, text STRING")
    row = st.finish_summary(st.partial_summary(twice, lexicon)).first()
    assert (row.num_posts, row.sentiment_avg, row.high_id, row.high_text) == (2, 5.0, 1, "good bad")


def test_zero_fill(spark, posts):
    entities = spark.createDataFrame(
        [("a", "x"), ("b", "x"), ("c", "y"), ("general", "general")], "first_term STRING, party STRING"
    )
    filled = st.zero_fill(st.count_by_entity(posts), entities)
    rows = {(r.batchtime, r.first_term): (r.party, r.num_posts) for r in filled.collect()}
    assert len(rows) == 12
    assert rows[(0, "a")] == ("x", 3) and rows[(60, "c")] == ("y", 0) and rows[(30, "general")] == ("general", 0)


def test_interval_profile(spark, posts, lexicon):
    rows = {(r.batchtime, r.first_term): r for r in st.interval_profile(posts, lexicon).collect()}
    row = rows[(0, "a")]
    assert (row["count"], row.total_word_ct) == (3, 7)
    assert row.prop_words_scored == pytest.approx(4 / 7)
    assert rows[(30, "c")].prop_words_scored == 0.0 and rows[(30, "c")].total_word_ct == 1


def test_lexicon_join_splits_all_tokens(spark, posts, lexicon):
    used, unused = st.lexicon_join(st.post_tokens(posts, "id"), lexicon)
    assert used.count() == 10 and unused.count() == 3


def test_histogram_edges(spark, lexicon):
    df = spark.createDataFrame(
        [(1, 0, "a", "good bad meh fine good"), (2, 0, "b", "bad bad")],
        "id LONG, batchtime LONG, first_term STRING, text STRING",
    )
    rows = {(r.first_term, r.bin): r["count"] for r in st.score_histogram(df, lexicon, 15).collect()}
    expected, _ = np.histogram([8, 2, 3.5, 6.5, 8], bins=15)
    assert {b: int(n) for b, n in enumerate(expected) if n} == {b: n for (e, b), n in rows.items() if e == "a"}
    assert rows[("b", 0)] == 2


def test_extreme_words_and_coverage(spark, posts, lexicon):
    words = {r.first_term: r for r in st.extreme_words(posts, lexicon).collect()}
    assert (words["a"].high_word, words["a"].low_word) == ("good", "bad")
    coverage = {r.first_term: r for r in st.lexicon_coverage(posts, lexicon).collect()}
    assert (coverage["a"].raw_words, coverage["a"].used_words) == (6, 3)
    assert (coverage["c"].raw_words, coverage["c"].used_words, coverage["c"].coverage) == (1, 0, 0.0)


def test_minute_labels(spark):
    df = spark.sql("SELECT timestamp_seconds(m * 60) AS ts FROM VALUES (0), (28), (29), (59) v(m)")
    got = {w: sorted(r.minute for r in st.minute_histogram(df, wrap=w).collect()) for w in ("minus_one", "clock", None)}
    assert got["minus_one"] == [-1, 0, 28, 29]
    assert got["clock"] == [829, 859, 860, 888]
    assert got[None] == [0, 28, 29, 59]


def test_batch_row_counts(spark, posts, lexicon):
    rows = st.batch_row_counts(posts, lexicon).collect()
    assert sum(r.rows_in for r in rows) == 9 and sum(r.rows_scored for r in rows) == 7


def test_no_text_is_shuffled_for_the_extremes(spark, posts, lexicon):
    plan = st.summary_numbers(posts, lexicon)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text" in line for line in exchanges)
