"""Posts, raw envelopes, terms and lexicon drawn from the star-schema tables.

The tables hold no posts, so ``documents`` (text, language) and ``events`` (time,
user, kind) are joined on their ids into one post per document. The dictionary and
the lexicon are small fixed lists of words that occur in those texts.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions import times as tm
from tidemark.operators.posts import primary_entity, tag_entities
from tidemark.session import spread_out
from tidemark.sources.readers import flatten_terms, neutral_removed

DICTIONARY = {
    "general": ["thnterble", "thanedble"],
    "candidates": {
        "north": {"rewh": ["rewh", "inoran"], "orre": ["orre", "hehely"], "thatin": ["thatin"]},
        "south": {"worthless": ["worthless", "thbleer"], "ononst": ["ononst", "orantion"]},
    },
}

# word, score: on both sides of neutral, on the edges of what is kept, and out of range
LEXICON = [
    ("the", 4.98), ("of", 3.22), ("and", 6.48), ("to", 4.0), ("a", 5.24), ("in", 5.5),
    ("is", 6.0), ("that", 4.01), ("for", 5.99), ("it", 2.18), ("was", 0.5), ("on", 9.5),
    ("with", 6.71), ("be", 6.18), ("as", 3.05), ("by", 7.14), ("are", 1.0), ("this", 9.0),
    ("at", 3.9), ("from", 6.3), ("rewh", 8.42), ("orre", 1.3), ("thatin", 7.76),
    ("ononst", 2.54), ("inoran", 6.9), ("hehely", 3.48), ("orantion", 7.02), ("worthless", 1.88),
    ("er", 7.3), ("ha", 8.1), ("nd", 2.92), ("re", 6.66), ("an", 3.7), ("he", 6.34),
    ("es", 2.26), ("en", 7.58), ("ti", 3.34), ("or", 6.12), ("ed", 8.0), ("ing", 2.0),
    ("nt", 7.9), ("ly", 3.62), ("ea", 6.84), ("ble", 1.44), ("ou", 8.22), ("st", 2.74),
    ("ther", 6.58), ("tion", 3.16), ("wh", 7.44), ("thon", 2.42), ("sh", 6.02), ("than", 3.98),
    ("thes", 8.64), ("then", 1.96), ("erin", 6.26), ("thor", 3.84), ("thing", 7.2), ("you", 6.24),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a file of a single row group is spread over the cores first."""
    return spread_out(table(spark, sf_dir, "documents"))


def terms(spark: SparkSession) -> DataFrame:
    return flatten_terms(spark.sql("SELECT :dictionary AS value", args={"dictionary": json.dumps(DICTIONARY)}))


def lexicon(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({_quoted(w)}, CAST({s} AS DOUBLE))" for w, s in LEXICON)
    return neutral_removed(spark.sql(f"SELECT word, score FROM VALUES {rows} AS v(word, score)"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per document: id, text, lang, source, ts (instant), user_id, event_type, value, k."""
    texts = documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text", "lang", "source")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        tm.utc_instant(F.col("ts")).alias("ts"),
        "user_id", "event_type", "value",
        F.regexp_extract("props", r"([0-9]+)", 1).cast("long").alias("k"),
    )
    return texts.join(events, "id")


def tagged_posts(spark: SparkSession, sf_dir: str, seconds: int = 3600) -> DataFrame:
    """All posts with their entities, ASCII text and interval."""
    return (
        primary_entity(tag_entities(posts(spark, sf_dir), terms(spark)))
        .withColumn("text", tx.ascii_only(F.col("text")))
        .withColumn("batchtime", tm.floor_interval(F.col("ts"), seconds))
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw post JSON as a ``value`` column, one line per post.

    The event decides what the line is: an error becomes a delete notice and a
    sign-up a repost; the number in the event's properties adds links, media,
    limit notices, damaged lines and arrays, and says where the user is.
    """
    k = F.col("k")
    user = F.struct(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("screen_name"),
        F.when(~k.between(30, 49), F.col("source")).alias("location"),
        F.when(k < 90, F.col("lang")).otherwise(F.lit("en")).alias("lang"),
    )
    link = F.struct(F.concat(F.lit("http://t.example/"), F.col("id").cast("string")).alias("url"))
    no_links = F.array().cast("array<struct<url:string>>")
    media = (
        F.when(k.between(10, 14), F.array(link))
        .when(k.between(15, 19), F.array(F.struct(F.lit(None).cast("string").alias("url"))))
    )
    entities = F.struct(
        F.array(
            F.struct(F.col("source").alias("text")),
            F.struct(F.concat(F.col("event_type"), F.lit("é")).alias("text")),
        ).alias("hashtags"),
        F.when(k < 10, F.array(link)).otherwise(no_links).alias("urls"),
        media.alias("media"),
    )
    created = F.date_format(tm.utc_wall_clock(F.col("ts")).cast("timestamp"), "E MMM dd HH:mm:ss '+0000' yyyy")
    post = F.to_json(
        F.struct(
            "id",
            created.alias("created_at"),
            "lang",
            "text",
            user.alias("user"),
            F.when(k.between(40, 69), F.struct(F.col("value").alias("lat"))).alias("geo"),
            entities.alias("entities"),
            F.when(F.col("event_type") == "signup", F.struct("id")).alias("retweeted_status"),
        )
    )
    delete = F.to_json(F.struct(F.struct("id").alias("delete")))
    limit = F.to_json(F.struct(F.struct(k.alias("track")).alias("limit")))
    line = (
        F.when(F.col("event_type") == "error", delete)
        .when(k.between(20, 22), limit)
        .when(k.between(23, 25), F.expr("substring(_post, 1, length(_post) - 1)"))
        .when(k == 26, F.concat(F.lit("["), F.col("_post"), F.lit("]")))
        .otherwise(F.col("_post"))
    )
    return posts(spark, sf_dir).withColumn("_post", post).select(line.alias("value"))


# ---------------------------------------------------------------- the same in SQL


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def entity_list(party: str | None = None) -> list[tuple[str, str, list[str]]]:
    """``(party, entity, terms)`` in dictionary order."""
    return [
        (p, entity, found)
        for p, entities in DICTIONARY["candidates"].items()
        for entity, found in entities.items()
        if party in (None, p)
    ]


def pooled_list() -> list[str]:
    return DICTIONARY["general"] + [t for _, _, found in entity_list() for t in found]


def pattern_sql(terms: list[str]) -> str:
    return _quoted(r"(?i)(^|[\s#@])(" + "|".join(terms) + ")")


def hits_sql(party: str | None = None, text: str = "text") -> str:
    """List of the mentioned entities, ``['general']`` when there is none."""
    cases = ", ".join(
        f"CASE WHEN regexp_matches({text}, {pattern_sql(found)}) THEN {_quoted(entity)} END"
        for _, entity, found in entity_list(party)
    )
    hits = f"list_filter([{cases}], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({hits}) > 0 THEN {hits} ELSE ['general'] END"


ASCII_SQL = r"regexp_replace({0}, '[^\x00-\x7F]', '', 'g')"
TOKENS_SQL = (
    "regexp_extract_all(lower(replace(replace(replace({0}, '---', ' '), '--', ' '), '''''', ' ')), "
    + _quoted(tx.TOKEN_PATTERN) + ")"
)


def floor_sql(ts: str, seconds: int) -> str:
    return f"CAST(epoch_us({ts}) // 1000000 - (epoch_us({ts}) // 1000000) % {seconds} AS BIGINT)"


POSTS_SQL = """posts AS (
  SELECT d.doc_id AS id, d.text, d.lang, d.source, e.ts, e.user_id, e.event_type, e.value,
         CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM documents d JOIN events e ON d.doc_id = e.event_id)"""

LEXICON_SQL = (
    "lexicon AS (SELECT word, score FROM (VALUES "
    + ", ".join(f"({_quoted(w)}, CAST({s} AS DOUBLE))" for w, s in LEXICON)
    + ") v(word, score) WHERE abs(score - 5.0) >= 1.0 AND score BETWEEN 1.0 AND 9.0)"
)


def tagged_sql(seconds: int = 3600, source: str = "posts", party: str | None = None) -> str:
    """CTEs up to ``tagged``, over all posts or over the ``eligible`` raw posts."""
    before = POSTS_SQL if source == "posts" else ELIGIBLE_SQL
    return f"""{before}, tagged AS (
  SELECT *, search_terms[1] AS first_term, len(search_terms) > 1 AS multiple_terms FROM (
    SELECT id, lang, source, ts, user_id, event_type, value, k, {ASCII_SQL.format('text')} AS text,
           {hits_sql(party)} AS search_terms, {floor_sql('ts', seconds)} AS batchtime
    FROM {source}))"""


# tokens of the tagged posts, scored where the lexicon has them
TOKENS_CTE = f"""{LEXICON_SQL}, tok AS (
  SELECT batchtime, first_term, id, unnest({TOKENS_SQL.format('text')}) AS word FROM tagged),
scored AS (SELECT tok.*, score FROM tok JOIN lexicon USING (word))"""

# what a raw line is, decided from the same columns as in ``envelopes``
ENVELOPE_SQL = f"""{POSTS_SQL}, lines AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 'delete' WHEN k BETWEEN 20 AND 22 THEN 'limit'
                 WHEN k BETWEEN 23 AND 26 THEN 'bad' ELSE 'post' END AS kind,
         event_type = 'signup' AS repost, k < 10 AS has_url,
         k BETWEEN 10 AND 19 AS has_media, k BETWEEN 10 AND 14 AS media_url,
         CASE WHEN k NOT BETWEEN 30 AND 49 THEN source END AS location,
         k BETWEEN 40 AND 69 AS has_geo,
         CASE WHEN k < 90 THEN lang ELSE 'en' END AS user_lang
  FROM posts)"""

ELIGIBLE_SQL = f"""{ENVELOPE_SQL}, eligible AS (
  SELECT * FROM lines WHERE kind = 'post' AND NOT repost AND lang = 'en' AND NOT has_url AND NOT has_media
    AND regexp_matches(text, {pattern_sql(pooled_list())}))"""
