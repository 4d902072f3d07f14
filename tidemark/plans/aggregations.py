"""Counts, sentiment summaries and the historic analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sentiment as st
from tidemark.plans import sample
from tidemark.plans.registry import fixed, fixed_sql, query

TAGGED = sample.tagged_sql()
SCORED = f"{TAGGED}, {sample.TOKENS_CTE}"
PER_POST = f"""{SCORED}, per_post AS (
  SELECT batchtime, first_term, id, avg(score) AS score FROM scored GROUP BY ALL)"""

SUMMARY_COLUMNS = f"""
  count(p.score) >= 2 AS enough,
  CASE WHEN count(p.score) >= 2 THEN {fixed_sql('max(p.score)')} END AS high_score,
  CASE WHEN count(p.score) >= 2 THEN arg_min(t.id, (-round(p.score, 9), t.id)) END AS high_id,
  CASE WHEN count(p.score) >= 2 THEN arg_min(t.text, (-round(p.score, 9), t.id)) END AS high_text,
  CASE WHEN count(p.score) >= 2 THEN {fixed_sql('min(p.score)')} END AS low_score,
  CASE WHEN count(p.score) >= 2 THEN arg_min(t.id, (round(p.score, 9), t.id)) END AS low_id,
  CASE WHEN count(p.score) >= 2 THEN arg_min(t.text, (round(p.score, 9), t.id)) END AS low_text"""


def summary_sql(ctes: str) -> str:
    """Entity summary with zero-filled entities over the CTEs ``tagged``, ``scored`` and ``per_post``."""
    entities = ", ".join(f"('{e}', '{p}')" for p, e, _ in sample.entity_list())
    return f"""WITH {ctes}, entities AS (
  SELECT * FROM (VALUES {entities}, ('general', 'general')) v(first_term, party)),
grid AS (SELECT * FROM (SELECT DISTINCT batchtime FROM tagged), entities),
counts AS (SELECT batchtime, first_term, count(*) AS num_posts FROM tagged GROUP BY ALL),
pooled AS (SELECT batchtime, first_term, {fixed_sql('avg(score)')} AS sentiment_avg,
                  {fixed_sql('stddev_pop(score)')} AS sentiment_std FROM scored GROUP BY ALL),
extremes AS (SELECT t.batchtime, t.first_term, {SUMMARY_COLUMNS}
             FROM tagged t JOIN per_post p USING (id) GROUP BY ALL)
SELECT batchtime, first_term, party, coalesce(num_posts, 0) AS num_posts, sentiment_avg, sentiment_std,
       high_score, high_id, high_text, low_score, low_id, low_text
FROM grid LEFT JOIN counts USING (batchtime, first_term) LEFT JOIN pooled USING (batchtime, first_term)
LEFT JOIN extremes USING (batchtime, first_term)"""


def rounded(summary, *columns):
    return summary.withColumns({c: fixed(c) for c in columns})


SUMMARY_DOUBLES = ("sentiment_avg", "sentiment_std", "high_score", "low_score")


@query(summary_sql(PER_POST))
def entity_summary(spark, sf_dir):
    posts = sample.tagged_posts(spark, sf_dir)
    summary = st.entity_summary(posts, sample.lexicon(spark), sample.terms(spark))
    return rounded(summary, *SUMMARY_DOUBLES).select(
        "batchtime", "first_term", "party", "num_posts", "sentiment_avg", "sentiment_std",
        "high_score", "high_id", "high_text", "low_score", "low_id", "low_text",
    )


@query(f"WITH {TAGGED} SELECT batchtime, first_term, count(*) AS num_posts FROM tagged GROUP BY ALL")
def count_by_entity(spark, sf_dir):
    return st.count_by_entity(sample.tagged_posts(spark, sf_dir))


SCORE_POSTS_SQL = f"""SELECT t.id, {fixed_sql('avg(score)')} AS score_avg,
  {fixed_sql('stddev_pop(score)')} AS score_std, count(score) AS words_used,
  CAST(any_value(len(string_split(t.text, ' '))) AS BIGINT) AS total_word_ct,
  {fixed_sql("count(score) / any_value(len(string_split(t.text, ' ')))")} AS prop_words_used
FROM tagged t LEFT JOIN scored s ON t.id = s.id GROUP BY t.id"""


def _score_posts(spark, sf_dir):
    scored = st.score_posts(sample.tagged_posts(spark, sf_dir), sample.lexicon(spark))
    return rounded(scored, "score_avg", "score_std", "prop_words_used")


@query(f"WITH {SCORED} {SCORE_POSTS_SQL}")
def score_posts(spark, sf_dir):
    return _score_posts(spark, sf_dir)


@query(f"WITH {SCORED} {SCORE_POSTS_SQL} HAVING count(score) > 0")
def scored_only(spark, sf_dir):
    return st.scored_only(_score_posts(spark, sf_dir))


@query(f"""WITH {SCORED} SELECT batchtime, first_term, {fixed_sql('avg(score)')} AS sentiment_avg,
  {fixed_sql('stddev_pop(score)')} AS sentiment_std
FROM tagged LEFT JOIN scored USING (batchtime, first_term, id) GROUP BY ALL""")
def pooled_sentiment(spark, sf_dir):
    pooled = st.pooled_sentiment(sample.tagged_posts(spark, sf_dir), sample.lexicon(spark))
    return rounded(pooled, "sentiment_avg", "sentiment_std")


@query(f"""WITH {PER_POST} SELECT batchtime, first_term, * EXCLUDE (enough, batchtime, first_term) FROM (
  SELECT t.batchtime, t.first_term, {SUMMARY_COLUMNS}
  FROM tagged t LEFT JOIN per_post p USING (id) GROUP BY ALL)""")
def extreme_posts(spark, sf_dir):
    extremes = st.extreme_posts(sample.tagged_posts(spark, sf_dir), sample.lexicon(spark))
    return rounded(extremes, "high_score", "low_score")


PROFILE = sample.tagged_sql(30)
PROFILE_SQL = f"""WITH {PROFILE}, {sample.TOKENS_CTE},
per_post AS (SELECT batchtime, first_term, id, any_value(len(string_split(text, ' '))) AS words
             FROM tagged GROUP BY ALL),
counted AS (SELECT batchtime, first_term, count(*) AS n, sum(words) AS words FROM per_post GROUP BY ALL)
SELECT c.batchtime, c.first_term, any_value(c.n) AS count, CAST(any_value(c.words) AS BIGINT) AS total_word_ct,
       {fixed_sql('avg(score)')} AS sentiment_avg, {fixed_sql('stddev_pop(score)')} AS sentiment_std,
       {fixed_sql('count(score) / any_value(c.words)')} AS prop_words_scored
FROM counted c LEFT JOIN scored s ON c.batchtime = s.batchtime AND c.first_term = s.first_term
GROUP BY c.batchtime, c.first_term"""


@query(PROFILE_SQL)
def interval_profile(spark, sf_dir):
    profile = st.interval_profile(sample.tagged_posts(spark, sf_dir, 30), sample.lexicon(spark))
    return rounded(profile, "sentiment_avg", "sentiment_std", "prop_words_scored")


@query(f"""WITH {SCORED} SELECT batchtime, first_term, {fixed_sql('avg(score)')} AS sentiment_avg,
  {fixed_sql('stddev_pop(score)')} AS sentiment_std, count(DISTINCT id) AS num_posts
FROM tagged LEFT JOIN scored USING (batchtime, first_term, id) GROUP BY ALL""")
def profile_join(spark, sf_dir):
    posts = sample.tagged_posts(spark, sf_dir)
    scores = st.pooled_sentiment(posts, sample.lexicon(spark))
    return rounded(st.profile_join(scores, st.count_by_entity(posts)), "sentiment_avg", "sentiment_std")


@query(f"WITH {PROFILE} SELECT first_term, batchtime, count(*) AS count FROM tagged GROUP BY ALL")
def count_series(spark, sf_dir):
    return st.count_series(sample.tagged_posts(spark, sf_dir, 30))


@query(f"WITH {TAGGED} SELECT DISTINCT first_term FROM tagged")
def distinct_entities(spark, sf_dir):
    return st.distinct_entities(sample.tagged_posts(spark, sf_dir))


LOCAL_MINUTE = "minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"


@query(f"""WITH {TAGGED}, m AS (SELECT CAST({LOCAL_MINUTE} AS INT) AS m FROM tagged)
SELECT 'minus_one' AS wrap, CASE WHEN m = 59 THEN -1 ELSE m END AS minute, count(*) AS count FROM m GROUP BY ALL
UNION ALL
SELECT 'clock', CASE WHEN m > 28 THEN m + 800 ELSE m + 860 END, count(*) FROM m GROUP BY ALL""")
def minute_histogram(spark, sf_dir):
    posts = sample.tagged_posts(spark, sf_dir)
    kinds = [
        st.minute_histogram(posts, wrap=wrap).select(F.lit(wrap).alias("wrap"), "minute", "count")
        for wrap in ("minus_one", "clock")
    ]
    return kinds[0].unionByName(kinds[1])


@query(f"""WITH {SCORED},
raw AS (SELECT first_term, unnest(string_split(text, ' ')) AS word FROM tagged),
r AS (SELECT first_term, count(DISTINCT word) AS raw_words FROM raw GROUP BY ALL),
u AS (SELECT first_term, count(DISTINCT word) AS used_words FROM scored GROUP BY ALL)
SELECT first_term, raw_words, coalesce(used_words, 0) AS used_words,
       {fixed_sql('coalesce(used_words, 0) / raw_words')} AS coverage
FROM r LEFT JOIN u USING (first_term)""")
def lexicon_coverage(spark, sf_dir):
    coverage = st.lexicon_coverage(sample.tagged_posts(spark, sf_dir), sample.lexicon(spark))
    return rounded(coverage, "coverage")


@query(f"""WITH {SCORED} SELECT first_term, arg_min(word, (-score, word)) AS high_word, max(score) AS high_score,
  arg_min(word, (score, word)) AS low_word, min(score) AS low_score FROM scored GROUP BY ALL""")
def extreme_words(spark, sf_dir):
    return st.extreme_words(sample.tagged_posts(spark, sf_dir), sample.lexicon(spark))


@query(f"""WITH {SCORED},
e AS (SELECT first_term, min(score) AS lo, max(score) AS hi FROM scored GROUP BY ALL)
SELECT first_term, CASE WHEN hi > lo THEN CAST(least(floor((score - lo) / ((hi - lo) / 15)), 14) AS INT) ELSE 0 END
         AS bin, count(*) AS count
FROM scored JOIN e USING (first_term) GROUP BY ALL""")
def score_histogram(spark, sf_dir):
    return st.score_histogram(sample.tagged_posts(spark, sf_dir), sample.lexicon(spark))


@query(f"""WITH {SCORED}, n AS (SELECT id, count(score) AS n FROM scored GROUP BY ALL)
SELECT batchtime, first_term, count(*) AS rows_in, count(n) AS rows_scored
FROM tagged LEFT JOIN n USING (id) GROUP BY ALL""")
def batch_row_counts(spark, sf_dir):
    return st.batch_row_counts(sample.tagged_posts(spark, sf_dir), sample.lexicon(spark))
