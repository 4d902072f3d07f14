"""Readers and writers: every query writes its input or output to a fresh shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import text as tx
from tidemark.operators import posts as ps
from tidemark.operators import results as rs
from tidemark.operators import sentiment as st
from tidemark.plans import sample
from tidemark.plans.aggregations import PER_POST, SUMMARY_DOUBLES, rounded, summary_sql
from tidemark.plans.parsing import (
    RECORD_SQL, RECORDS, SCHEDULE_SQL, flat, schedule_from_html, tagged_records,
)
from tidemark.plans.registry import query
from tidemark.session import explode_words, new_folder, store
from tidemark.sources import items, readers, writers

# ---------------------------------------------------------------- readers


@query(f"""WITH {sample.ENVELOPE_SQL}
SELECT CASE WHEN kind = 'post' THEN lang END AS lang, count(*) AS posts, CAST(sum(length(text)) FILTER (kind = 'post') AS BIGINT) AS chars
FROM lines WHERE kind <> 'bad' GROUP BY 1""")
def scan_archive(spark, sf_dir):
    path = new_folder(spark, "archive")
    sample.envelopes(spark, sf_dir).write.option("compression", "gzip").text(path)
    good, _ = ps.decode_posts(readers.scan_archive(spark, f"{path}/*.gz", min_parts=8))
    return good.groupBy("lang").agg(F.count(F.lit(1)).alias("posts"), F.sum(F.length("text")).alias("chars"))


def dictionary_lines(spark, sf_dir):
    """One JSON term dictionary per document: its language the party, its source the entity."""
    words = tx.whitespace_words(F.col("text"))
    return sample.documents(spark, sf_dir).select(
        F.to_json(
            F.struct(
                F.slice(words, 1, 1).alias("general"),
                F.create_map("lang", F.create_map("source", words)).alias("candidates"),
            )
        ).alias("value")
    )


WORDS_SQL = "list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')"
DICTIONARY_SQL = f"""w AS (SELECT lang, source, {WORDS_SQL} AS words FROM documents),
terms AS (
  SELECT lang AS party, source AS entity, 0 AS entity_pos, unnest(words) AS term,
         generate_subscripts(words, 1) - 1 AS term_pos FROM w
  UNION ALL SELECT 'general', 'general', -1, words[1], 0 FROM w WHERE len(words) > 0)"""


@query(f"""WITH {DICTIONARY_SQL}
SELECT party, entity, entity_pos, count(*) AS n, count(DISTINCT term) AS n_distinct,
       CAST(sum(length(term)) AS BIGINT) AS chars, CAST(sum(term_pos) AS BIGINT) AS places
FROM terms GROUP BY ALL""")
def load_terms(spark, sf_dir):
    path = new_folder(spark, "terms")
    dictionary_lines(spark, sf_dir).write.text(path)
    return readers.load_terms(spark, path).groupBy("party", "entity", "entity_pos").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("term").alias("n_distinct"),
        F.sum(F.length("term")).alias("chars"), F.sum("term_pos").alias("places"),
    )


@query(f"WITH {DICTIONARY_SQL} SELECT term, count(*) AS n FROM terms GROUP BY ALL")
def pool_terms(spark, sf_dir):
    terms = readers.flatten_terms(dictionary_lines(spark, sf_dir))
    return readers.pool_terms(terms).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def word_counts(spark, sf_dir):
    tokens = tx.word_tokens(tx.ascii_only(F.col("text")))
    return (
        explode_words(sample.documents(spark, sf_dir), [], tokens)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )


WORD_COUNTS_SQL = f"""words AS (SELECT word, count(*) AS n FROM (
  SELECT unnest({sample.TOKENS_SQL.format(sample.ASCII_SQL.format('text'))}) AS word FROM documents) GROUP BY ALL)"""


@query(f"""WITH {WORD_COUNTS_SQL}, l AS (SELECT word, 1 + ((n * 37 + length(word) * 11) % 900) / 100.0 AS score FROM words)
SELECT word, CAST(score AS DOUBLE) AS score FROM l WHERE abs(score - 5.0) >= 1.0 AND score BETWEEN 1.0 AND 9.0""")
def load_lexicon(spark, sf_dir):
    path = new_folder(spark, "lexicon")
    score = 1 + F.pmod(F.col("n") * 37 + F.length("word") * 11, F.lit(900)) / 100.0
    word_counts(spark, sf_dir).select(
        "word", F.col("n").alias("happiness_rank"), score.alias("happiness_average")
    ).write.csv(path, sep="\t", header=True, quoteAll=True)
    return readers.load_lexicon(spark, path)


@query(f"WITH {WORD_COUNTS_SQL} SELECT n, count(*) AS terms, CAST(sum(length(word)) AS BIGINT) AS chars FROM words GROUP BY ALL")
def scan_csv_terms(spark, sf_dir):
    path = new_folder(spark, "term-table")
    word_counts(spark, sf_dir).withColumnRenamed("word", "term").write.csv(path, header=True)
    readers.scan_csv_terms(spark, path, "term_table")
    return spark.sql(
        "SELECT CAST(n AS BIGINT) AS n, count(*) AS terms, sum(length(term)) AS chars FROM term_table GROUP BY n"
    )


@query("SELECT md5(text) AS digest, length(text) AS chars FROM documents")
def scan_delimited_docs(spark, sf_dir):
    path = new_folder(spark, "delimited")
    ended = sample.documents(spark, sf_dir).select(F.concat("text", F.lit("\n")).alias("value"))
    ended.write.option("lineSep", "&&&&&").text(path)
    docs = readers.scan_delimited_docs(spark, path)
    return docs.select(F.md5("text").alias("digest"), F.length("text").cast("long").alias("chars"))


def hour_of(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d-%H')"


def hourly_folder(spark, sf_dir) -> str:
    path = new_folder(spark, "hourly")
    writers.sink_hourly_json(tagged_records(spark, sf_dir), path)
    return path


@query(f"""WITH {RECORDS} SELECT first_term, text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, id AS tweet_id,
  'user' || user_id AS username FROM tagged""")
def scan_reduced(spark, sf_dir):
    return readers.scan_reduced(spark, [f"{hourly_folder(spark, sf_dir)}/hour=*"])


def summary_of_tagged(spark, sf_dir):
    summary = st.entity_summary(
        sample.tagged_posts(spark, sf_dir), sample.lexicon(spark), sample.terms(spark)
    )
    return rounded(summary, *SUMMARY_DOUBLES)


ITEM = "first_term || '_' || batchtime AS item, CAST(batchtime AS VARCHAR) AS timestamp, first_term AS candidate"
STORED = ["data", "timestamp", "candidate"]


def stored_items(spark, sf_dir):
    path = new_folder(spark, "summary")
    writers.sink_summary(rs.summary_items(summary_of_tagged(spark, sf_dir)), path, 0)
    return readers.scan_results(spark, path)


@query(f"SELECT {ITEM}, CAST(num_posts AS VARCHAR) AS num_tweets FROM ({summary_sql(PER_POST)})")
def scan_results(spark, sf_dir):
    wide = rs.eav_pivot(stored_items(spark, sf_dir), STORED)
    return wide.select(
        "item", "timestamp", "candidate", F.get_json_object("data", "$.num_tweets").alias("num_tweets")
    )


# ---------------------------------------------------------------- writers


@query(RECORD_SQL)
def sink_posts(spark, sf_dir):
    """Posts as items that tasks write and the driver commits; a retried batch replaces itself."""
    path = new_folder(spark, "posts")
    records = store(tagged_records(spark, sf_dir), "records")  # else every batch would join the texts anew
    for batch, half in ((6, "id % 2 = 0"), (7, "id % 2 = 1"), (7, "id % 2 = 1")):
        items.sink_items(records.filter(half), path, batch)
    return flat(items.read_items(spark, path, records.schema))


@query(f"""SELECT {ITEM}, party, num_posts, sentiment_avg, sentiment_std, high_score, coalesce(high_text, '') AS high_text,
  low_score, coalesce(low_text, '') AS low_text FROM ({summary_sql(PER_POST)})""")
def sink_summary(spark, sf_dir):
    wide = rs.eav_pivot(stored_items(spark, sf_dir), STORED)

    def field(name: str):
        return F.get_json_object("data", f"$.{name}")

    def extreme(name: str):
        score = F.substring_index(field(name), "_", 1)
        return score.try_cast("double"), F.expr(
            f"substring(get_json_object(data, '$.{name}'), instr(get_json_object(data, '$.{name}'), '_') + 1)"
        )

    high, low = extreme("highest_sentiment_tweet"), extreme("lowest_sentiment_tweet")
    return wide.select(
        "item", "timestamp", "candidate", field("party").alias("party"),
        field("num_tweets").cast("long").alias("num_posts"),
        field("sentiment_avg").try_cast("double").alias("sentiment_avg"),
        field("sentiment_std").try_cast("double").alias("sentiment_std"),
        high[0].alias("high_score"), high[1].alias("high_text"),
        low[0].alias("low_score"), low[1].alias("low_text"),
    )


@query(RECORD_SQL)
def sink_gzip_text(spark, sf_dir):
    path = new_folder(spark, "gzip")
    writers.sink_gzip_text(tagged_records(spark, sf_dir), path)
    return flat(spark.read.schema(schemas.TAGGED_POST).json(path))


@query(f"""WITH {RECORDS} SELECT id AS tweet_id, text, first_term, {hour_of('ts')} AS hour FROM tagged""")
def sink_hourly_json(spark, sf_dir):
    return spark.read.schema("tweet_id BIGINT, text STRING, first_term STRING, hour STRING").json(
        hourly_folder(spark, sf_dir)
    )


@query(SCHEDULE_SQL)
def sink_quoted_csv(spark, sf_dir):
    path = new_folder(spark, "schedule")
    rows = schedule_from_html(spark, sf_dir)
    writers.sink_quoted_csv(rows, path)
    back = spark.read.schema(rows.schema).csv(path, header=True, escape='"')
    return back.withColumn("caveat", F.coalesce("caveat", F.lit("")))
