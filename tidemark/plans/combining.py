"""Joins, the result store's reads, the schedule and prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import times as tm
from tidemark.operators import pricing as pr
from tidemark.operators import results as rs
from tidemark.operators import schedule as sc
from tidemark.operators import sentiment as st
from tidemark.plans import sample
from tidemark.plans.aggregations import PROFILE_SQL, SCORED, TAGGED, rounded
from tidemark.plans.parsing import registered_days
from tidemark.plans.registry import fixed, fixed_sql, query
from tidemark.session import new_folder
from tidemark.sources import readers, writers

ENTITIES = ", ".join(f"('{e}', '{p}')" for p, e, _ in sample.entity_list())


@query(f"""WITH {TAGGED}, entities AS (
  SELECT * FROM (VALUES {ENTITIES}, ('general', 'general')) v(first_term, party)),
grid AS (SELECT * FROM (SELECT DISTINCT batchtime FROM tagged), entities),
counts AS (SELECT batchtime, first_term, count(*) AS n FROM tagged GROUP BY ALL)
SELECT batchtime, first_term, party, coalesce(n, 0) AS num_posts FROM grid LEFT JOIN counts USING (batchtime, first_term)""")
def zero_fill(spark, sf_dir):
    counts = st.count_by_entity(sample.tagged_posts(spark, sf_dir))
    return st.zero_fill(counts, st.entities_with_general(sample.terms(spark), None))


@query(f"""WITH {SCORED}
SELECT 'used' AS kind, word, count(*) AS n FROM scored GROUP BY ALL UNION ALL
SELECT 'unused', word, count(*) FROM tok WHERE word NOT IN (SELECT word FROM lexicon) GROUP BY ALL""")
def lexicon_join(spark, sf_dir):
    tokens = st.post_tokens(sample.tagged_posts(spark, sf_dir), "id")
    used, unused = st.lexicon_join(tokens, sample.lexicon(spark))
    return (
        used.groupBy("word").count().withColumn("kind", F.lit("used"))
        .unionByName(unused.groupBy("word").count().withColumn("kind", F.lit("unused")))
        .withColumnRenamed("count", "n")
    )


GRACE = 600


@query(f"""WITH p AS (SELECT event_id, epoch_us(ts) // 1000000 AS epoch FROM events),
s AS (SELECT event_id AS ordinal, epoch_us(ts) // 1000000 AS start FROM events WHERE event_type = 'purchase'),
best AS (SELECT p.event_id, min((abs(start - epoch), ordinal, start)) AS b FROM p JOIN s
         ON start > epoch OR epoch - start <= {GRACE} GROUP BY ALL)
SELECT p.event_id, epoch, b[2] AS ordinal, b[3] AS start, b[3] - epoch AS delta FROM p LEFT JOIN best USING (event_id)""")
def nearest_event(spark, sf_dir):
    events = sample.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.unix_seconds(tm.utc_instant(F.col("ts"))).alias("epoch")
    )
    schedule = events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("ordinal"), F.col("epoch").alias("start")
    )
    return sc.nearest_event(events.select("event_id", "epoch"), schedule, grace=GRACE)


# ---------------------------------------------------------------- stored results

RESULTS_SQL = f"""results AS (SELECT first_term AS entity, batchtime AS timestamp, {fixed_sql('avg(score)')} AS score
  FROM tagged LEFT JOIN scored USING (batchtime, first_term, id) GROUP BY ALL)"""


def results(spark, sf_dir):
    pooled = st.pooled_sentiment(sample.tagged_posts(spark, sf_dir), sample.lexicon(spark))
    return pooled.select(
        F.col("first_term").alias("entity"), F.col("batchtime").alias("timestamp"),
        fixed("sentiment_avg").alias("score"),
    )


def stored_results(spark, sf_dir):
    """The results as a table in day folders."""
    path = new_folder(spark, "results")
    writers.sink_results(results(spark, sf_dir), path)
    return readers.scan_results(spark, path)


START = 1704067200  # 2024-01-01 00:00 UTC, where the events begin
RANGE = (START + 2 * 3600, START + 30 * 3600)


@query(f"""WITH {SCORED}, {RESULTS_SQL}
SELECT 'range' AS kind, * FROM results WHERE timestamp BETWEEN {RANGE[0]} AND {RANGE[1]} UNION ALL
SELECT 'exact', * FROM results WHERE timestamp = {RANGE[0]}""")
def summary_range(spark, sf_dir):
    stored = stored_results(spark, sf_dir)
    return (
        rs.summary_range(stored, *RANGE).withColumn("kind", F.lit("range"))
        .unionByName(rs.summary_range(stored, RANGE[0], 0).withColumn("kind", F.lit("exact")))
        .drop("day")
    )


@query(f"WITH {SCORED}, {RESULTS_SQL} SELECT * FROM results WHERE timestamp = {START + 4 * 3600}")
def latest_closed_interval(spark, sf_dir):
    return rs.latest_closed_interval(stored_results(spark, sf_dir), START + 5 * 3600 + 1234, 3600).drop("day")


@query(f"""WITH {SCORED}, {RESULTS_SQL}
SELECT 'initial' AS phase, * FROM results WHERE timestamp BETWEEN {RANGE[0]} AND {RANGE[0] + 1200} UNION ALL
SELECT 'full', * FROM results WHERE timestamp BETWEEN {RANGE[0]} AND {RANGE[1]}""")
def initial_then_full(spark, sf_dir):
    return rs.initial_then_full(stored_results(spark, sf_dir), *RANGE).drop("day")


@query(f"WITH {TAGGED} SELECT min(batchtime) AS first_ts, max(batchtime) AS last_ts FROM tagged")
def time_bounds(spark, sf_dir):
    return rs.time_bounds(results(spark, sf_dir))


def profile_items(spark, sf_dir):
    profile = st.interval_profile(sample.tagged_posts(spark, sf_dir, 30), sample.lexicon(spark))
    return rs.profile_items(rounded(profile, "sentiment_avg", "sentiment_std", "prop_words_scored"))


ATTRIBUTES = ["data", "timestamp", "candidate"]


@query(f"""SELECT first_term || '_' || batchtime AS item, CAST(batchtime AS VARCHAR) AS timestamp,
  first_term AS candidate, count, total_word_ct, sentiment_avg FROM ({PROFILE_SQL})""")
def eav_pivot(spark, sf_dir):
    wide = rs.eav_pivot(profile_items(spark, sf_dir), ATTRIBUTES)
    data = F.from_json("data", "count BIGINT, total_word_ct BIGINT, sentiment_avg DOUBLE")
    return wide.select("item", "timestamp", "candidate", data.alias("d")).select(
        "item", "timestamp", "candidate", "d.*"
    )


SHOWN = "CASE WHEN {0} > 0 THEN " + fixed_sql("{0}", 2) + " END"


@query(f"""SELECT first_term AS entity, batchtime * 1000 - batchtime * 1000 % 86400000 AS day, batchtime * 1000 AS x,
  {SHOWN.format('sentiment_avg')} AS y, {SHOWN.format('sentiment_std')} AS std,
  CAST(row_number() OVER (PARTITION BY first_term, batchtime // 86400 ORDER BY batchtime) - 1 AS INT) AS place
FROM ({PROFILE_SQL})""")
def entity_series(spark, sf_dir):
    wide = rs.eav_pivot(profile_items(spark, sf_dir), ATTRIBUTES)
    series = rs.entity_series(rs.series_points(wide))
    return series.select("entity", "day", F.posexplode("points").alias("place", "p")).select(
        "entity", "day", "place", "p.x", "p.y", "p.std"
    )


APPENDED_SQL = f"""WITH {SCORED}, {RESULTS_SQL}, points AS (
  SELECT entity, timestamp AS x, CASE WHEN score > 0 THEN {fixed_sql('score', 2)} END AS y FROM results),
master AS (SELECT * FROM points WHERE entity <> 'general' AND x < {RANGE[1]}),
fresh AS (SELECT * FROM points WHERE x >= {RANGE[1]}),
welcome AS (SELECT entity FROM master UNION SELECT entity FROM (
  SELECT entity, arg_min_null(y, x) AS y FROM fresh GROUP BY ALL) WHERE y IS NOT NULL)
SELECT entity, x, y FROM master UNION ALL SELECT entity, x, y FROM fresh WHERE entity IN (SELECT entity FROM welcome)"""


@query(APPENDED_SQL)
def append_series(spark, sf_dir):
    points = stored_results(spark, sf_dir).select(
        "entity", F.col("timestamp").alias("x"), F.when(F.col("score") > 0, fixed("score", 2)).alias("y")
    )
    master = points.filter((F.col("entity") != "general") & (F.col("x") < RANGE[1]))
    return rs.append_series(master, points.filter(F.col("x") >= RANGE[1]))


@query("""WITH d AS (SELECT DISTINCT event_type AS party, lower(strftime(ts, '%Y_%b_%d')) AS ddate FROM events)
SELECT party, ddate, row_number() OVER (ORDER BY party, ddate) AS row_id FROM d""")
def number_rows(spark, sf_dir):
    return rs.number_rows(registered_days(spark, sf_dir), ["party", "ddate"])


# ---------------------------------------------------------------- prices

ROUNDED_BID = f"greatest({fixed_sql('price * 1.2', 3)}, CAST(0.015 AS DOUBLE))"


@query(f"""WITH m AS (SELECT user_id % 5 AS grp, event_type AS item, {fixed_sql('avg(value)', 3)} AS price
  FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31' GROUP BY ALL),
best AS (SELECT grp FROM m WHERE item = 'click' ORDER BY price, grp LIMIT 1)
SELECT i.item, best.grp, price, coalesce({ROUNDED_BID}, CAST(0.015 AS DOUBLE)) AS bid
FROM best, (VALUES ('click'), ('view')) i(item) LEFT JOIN m ON m.item = i.item AND m.grp = best.grp""")
def cheapest_group(spark, sf_dir):
    prices = sample.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("item"), F.pmod("user_id", F.lit(5).cast("long")).alias("grp"),
        tm.utc_instant(F.col("ts")).alias("ts"), F.col("value").alias("price"),
    )
    now = tm.utc_instant(F.expr("timestamp_ntz'2024-01-31 00:00:00'"))
    return pr.cheapest_group(prices, "click", "view", now, hours=24 * 30)
