"""Decoding, time handling and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import text as tx
from tidemark.functions import times as tm
from tidemark.operators import posts as ps
from tidemark.operators import schedule as sc
from tidemark.plans import sample
from tidemark.plans.registry import query
from tidemark.sources import writers

DECODED_SQL = f"""WITH {sample.ENVELOPE_SQL}
SELECT kind, CASE WHEN kind = 'post' THEN id END AS id, CASE WHEN kind = 'post' THEN lang END AS lang,
       CASE WHEN kind = 'post' THEN length(text) END AS chars,
       CASE WHEN kind = 'post' THEN 'user' || user_id END AS username,
       CASE WHEN kind = 'post' THEN CAST(has_url AS INT) END AS links,
       kind = 'post' AND has_media AS media, kind = 'post' AND repost AS repost
FROM lines"""


def decoded_rows(raw):
    """Decoded lines and dead letters in one table, told apart by ``kind``, in one parse."""
    dead = F.col("_dead")
    kind = (
        F.when(dead, "bad").when(F.col("delete").isNotNull(), "delete")
        .when(F.col("limit").isNotNull(), "limit").otherwise("post")
    )
    fields = {
        "id": F.col("id"), "lang": F.col("lang"), "chars": F.length("text").cast("long"),
        "username": F.col("user.screen_name"), "links": F.size("entities.urls"),
    }
    rows = ps.parse_posts(raw).select(
        kind.alias("kind"), *[F.when(~dead, col).alias(name) for name, col in fields.items()],
        (~dead & F.col("entities.media").isNotNull()).alias("media"),
        (~dead & F.col("retweeted_status").isNotNull()).alias("repost"),
    )
    return rows.withColumn("links", F.when(F.col("kind") == "post", F.col("links")))


@query(DECODED_SQL)
def decode_posts(spark, sf_dir):
    return decoded_rows(sample.envelopes(spark, sf_dir))


def good_posts(spark, sf_dir):
    return ps.decode_posts(sample.envelopes(spark, sf_dir))[0]


def eligible(spark, sf_dir):
    return ps.eligible_posts(good_posts(spark, sf_dir), sample.terms(spark))


@query(f"""WITH {sample.ENVELOPE_SQL}
SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, epoch_us(ts) // 1000000 AS epoch
FROM lines WHERE kind = 'post'""")
def parse_created_at(spark, sf_dir):
    ts = tm.parse_created_at(F.col("created_at"))
    return good_posts(spark, sf_dir).filter(F.col("id").isNotNull()).select(
        "id", tm.wall_text(tm.utc_wall_clock(ts)).alias("timestamp"), F.unix_seconds(ts).alias("epoch")
    )


@query(f"""SELECT event_id, {sample.floor_sql('ts', 30)} AS half_minute, {sample.floor_sql('ts', 3600)} AS hour
FROM events""")
def floor_interval(spark, sf_dir):
    ts = tm.utc_instant(F.col("ts"))
    return sample.table(spark, sf_dir, "events").select(
        "event_id", tm.floor_interval(ts).alias("half_minute"), tm.floor_interval(ts, 3600).alias("hour")
    )


@query("""SELECT o_orderkey, strftime((o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York',
                  '%Y-%m-%d %H:%M:%S') AS local_time FROM orders""")
def to_local(spark, sf_dir):
    local = tm.to_local(tm.utc_instant(F.col("o_orderdate").cast("timestamp_ntz")))
    return sample.table(spark, sf_dir, "orders").select("o_orderkey", tm.wall_text(local).alias("local_time"))


def flat(tagged):
    """Tagged records with their lists joined, as the comparison wants plain columns."""
    return tagged.withColumns(
        {"hashtags": F.array_join("hashtags", "|"), "search_terms": F.array_join("search_terms", "|")}
    )


RECORDS = sample.tagged_sql(30, "eligible")
RECORD_SQL = f"""WITH {RECORDS}
SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, batchtime, 'user' || user_id AS username, text,
       source || '|' || event_type AS hashtags, first_term, array_to_string(search_terms, '|') AS search_terms,
       multiple_terms FROM tagged"""


def tagged_records(spark, sf_dir, seconds=30):
    return ps.project_fields(eligible(spark, sf_dir), sample.terms(spark), seconds=seconds)


@query(RECORD_SQL)
def project_fields(spark, sf_dir):
    return flat(tagged_records(spark, sf_dir))


CREATED = "strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') AS timestamp"


@query(f"""WITH {sample.ENVELOPE_SQL}
SELECT id, {CREATED}, 'user' || user_id AS username, text, source || '|' || event_type || 'é' AS hashtags,
       CASE WHEN has_geo THEN value END AS lat, location AS user_loc
FROM lines WHERE kind = 'post'""")
def project_geo_fields(spark, sf_dir):
    plain = ps.project_geo_fields(good_posts(spark, sf_dir).filter(F.col("id").isNotNull()))
    return plain.select(
        "id", "timestamp", "username", "text", F.array_join("hashtags", "|").alias("hashtags"),
        F.get_json_object("geotag", "$.lat").cast("double").alias("lat"), "user_loc",
    )


@query(f"""WITH {sample.ENVELOPE_SQL}
SELECT {CREATED}, 'user' || user_id AS screename, location, CASE WHEN has_geo THEN value END AS lat, text AS tweet,
       source || ',' || event_type || 'é,' AS hashtags
FROM lines WHERE kind = 'post'""")
def project_geo_fields_short(spark, sf_dir):
    short = ps.project_geo_fields(good_posts(spark, sf_dir).filter(F.col("id").isNotNull()), jq_names=True)
    return short.withColumn("lat", F.get_json_object("geo", "$.lat").cast("double")).drop("geo")


@query(f"SELECT doc_id, {sample.ASCII_SQL.format('text')} AS text FROM documents")
def ascii_only(spark, sf_dir):
    return sample.documents(spark, sf_dir).select("doc_id", tx.ascii_only(F.col("text")).alias("text"))


@query(f"""WITH {sample.ENVELOPE_SQL}, tags AS (SELECT id, unnest([source, event_type || 'é']) AS tag,
  generate_subscripts([source, event_type], 1) - 1 AS pos FROM lines WHERE kind = 'post')
SELECT id, CAST(pos AS INT) AS pos, tag FROM tags""")
def hashtag_texts(spark, sf_dir):
    good = good_posts(spark, sf_dir).filter(F.col("id").isNotNull())
    return good.select("id", F.posexplode(tx.hashtag_texts(F.col("entities.hashtags"))).alias("pos", "tag"))


@query(f"""WITH {sample.ENVELOPE_SQL} SELECT id, source || ',' || event_type || 'é,' AS tags
FROM lines WHERE kind = 'post'""")
def hashtags_joined(spark, sf_dir):
    good = good_posts(spark, sf_dir).filter(F.col("id").isNotNull())
    tags = tx.hashtag_texts(F.col("entities.hashtags"))
    return good.select("id", tx.joined_with_trailing_comma(tags).alias("tags"))


@query(RECORD_SQL)
def typed_rows(spark, sf_dir):
    loose = tagged_records(spark, sf_dir).withColumns(
        {"id": F.col("id").cast("string"), "batchtime": F.col("batchtime").cast("string")}
    )
    return flat(ps.typed_rows(loose))


@query(RECORD_SQL)
def record_json(spark, sf_dir):
    lines = ps.record_json(tagged_records(spark, sf_dir))
    return flat(lines.select(F.from_json("value", schemas.TAGGED_POST).alias("r")).select("r.*"))


@query(f"""WITH {RECORDS}, r AS (
  SELECT CAST(id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CAST(batchtime AS VARCHAR) AS batchtime,
         'user' || user_id AS username, text, source || ',' || event_type AS hashtags, first_term,
         array_to_string(search_terms, ',') AS search_terms,
         CASE WHEN multiple_terms THEN 'True' ELSE 'False' END AS multiple_terms FROM tagged)
UNPIVOT r ON timestamp, batchtime, username, text, hashtags, first_term, search_terms, multiple_terms
INTO NAME name VALUE value""")
def eav_melt(spark, sf_dir):
    return writers.eav_melt(tagged_records(spark, sf_dir), "id")


def _marked_sql(start: str, end: str) -> str:
    rest = f"substr(html, strpos(html, '{start}') + {len(start)})"
    return (
        f"CASE WHEN strpos(html, '{start}') > 0 AND strpos({rest}, '{end}') > 0 "
        f"THEN substr({rest}, 1, strpos({rest}, '{end}') - 1) END"
    )


@query(f"""SELECT page_id, {_marked_sql('<title>', '</title>')} AS title, {_marked_sql('lang="', '"')} AS lang,
       {_marked_sql('<h2>', '</h2>')} AS subtitle FROM pages""")
def marked_field(spark, sf_dir):
    html = F.col("html")
    return sample.table(spark, sf_dir, "pages").select(
        "page_id",
        tx.between_markers(html, "<title>", "</title>").alias("title"),
        tx.between_markers(html, 'lang="', '"').alias("lang"),
        tx.between_markers(html, "<h2>", "</h2>").alias("subtitle"),
    )


def schedule_pages(spark, sf_dir):
    """One schedule page per event: its own item, and one whose time or date is not settled."""
    ts = F.col("ts").cast("timestamp")
    hour = F.pmod(F.hour(ts), F.lit(12)) + 1
    clock = F.when(F.minute(ts) < 6, F.format_string("%d p.m. ET", hour)).otherwise(
        F.format_string("%d:%02d p.m. ET", hour, F.minute(ts))
    )
    return sample.table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(
            F.lit('<html><ul><li class="debate-schedule-item"><span class="party">'), F.initcap("event_type"),
            F.lit(' debate</span><span class="date">'), F.date_format(ts, "MMM. d, yyyy"),
            F.lit('</span><p><span class="label">Time:</span> '), clock,
            F.lit('</p></li>\n<li class="debate-schedule-item"><span class="party">'), F.initcap("event_type"),
            F.lit('</span><span class="date">'),
            F.when(F.col("event_type") == "error", "To be announced").otherwise(F.date_format(ts, "MMMM d, yyyy")),
            F.lit("</span></li></ul></html>"),
        ).alias("html"),
    )


SCHEDULE_SQL = f"""WITH e AS (SELECT event_id, upper(event_type[1]) || event_type[2:] AS party, event_type, ts,
  hour(ts) % 12 + 13 AS h, CASE WHEN minute(ts) < 6 THEN 0 ELSE minute(ts) END AS m FROM events),
own AS (SELECT event_id, party, strftime(ts, '%b ') || day(ts) || strftime(ts, ' %Y') AS date,
  printf('%02d:%02d', CASE WHEN h = 24 THEN 12 ELSE h END, m) AS time, ts, '' AS caveat FROM e),
other AS (SELECT event_id, party, strftime(ts, '%B ') || day(ts) || strftime(ts, ' %Y') AS date, '20:00' AS time, ts,
  '{sc.CAVEAT}' AS caveat FROM e WHERE event_type <> 'error')
SELECT event_id, party, date, time, strftime(ts, '%Y-%m-%d') || 'T' || time || ':00' AS datetime, caveat
FROM (SELECT * FROM own UNION ALL SELECT * FROM other)"""


@query(SCHEDULE_SQL)
def schedule_from_html(spark, sf_dir):
    return sc.schedule_from_html(schedule_pages(spark, sf_dir))


@query("""WITH d AS (SELECT DISTINCT event_type AS party, lower(strftime(ts, '%Y_%b_%d')) AS ddate, ts::DATE AS day FROM events)
SELECT party, ddate, strftime(day, '%b %d %Y') || ' (' || upper(party) || ')' AS label,
       'Sentiment: ' || strftime(day, '%b %d %Y') || ' ' || upper(party) || ' debate' AS title FROM d""")
def label_title(spark, sf_dir):
    registry = registered_days(spark, sf_dir)
    return registry.select(
        "party", "ddate",
        tx.debate_label(F.col("ddate"), F.col("party")).alias("label"),
        tx.chart_title(F.col("ddate"), F.col("party"), "Sentiment").alias("title"),
    )


def registered_days(spark, sf_dir):
    """Distinct (party, date) pairs, the date written like ``2015_sep_16``."""
    return sample.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("party"),
        F.lower(F.date_format(F.col("ts").cast("timestamp"), "yyyy_MMM_dd")).alias("ddate"),
    ).distinct()
