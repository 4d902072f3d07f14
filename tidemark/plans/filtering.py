"""Filters and entity tagging."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions import times as tm
from tidemark.operators import mentions
from tidemark.operators import posts as ps
from tidemark.plans import sample
from tidemark.plans.parsing import eligible, good_posts
from tidemark.plans.registry import query

POOLED = sample.pattern_sql(sample.pooled_list())


def ids_and_text(posts):
    return posts.select("id", "lang", "text")


@query(f"WITH {sample.ELIGIBLE_SQL} SELECT id, lang, text FROM eligible")
def eligible_posts(spark, sf_dir):
    return ids_and_text(eligible(spark, sf_dir))


@query(f"""WITH {sample.ENVELOPE_SQL}
SELECT 'any' AS variant, id, lang, text FROM lines
WHERE kind = 'post' AND NOT repost AND user_lang = 'en' AND NOT has_url AND NOT has_media
  AND (has_geo OR location IS NOT NULL)
UNION ALL
SELECT 'needle', id, lang, text FROM lines
WHERE kind = 'post' AND NOT repost AND user_lang = 'en' AND NOT has_url AND (has_geo OR location <> '')
  AND contains(lower(text), 'rewh')""")
def eligible_geo(spark, sf_dir):
    good = good_posts(spark, sf_dir)
    return (
        ids_and_text(ps.eligible_geo(good)).withColumn("variant", F.lit("any"))
        .unionByName(ids_and_text(ps.eligible_geo(good, "Rewh")).withColumn("variant", F.lit("needle")))
    )


@query(f"""WITH {sample.ENVELOPE_SQL} SELECT id, lang, text FROM lines
WHERE kind = 'post' AND NOT repost AND NOT has_url AND NOT media_url""")
def eligible_media_without_url(spark, sf_dir):
    return ids_and_text(ps.eligible_media_without_url(good_posts(spark, sf_dir)))


COMPAT = "'(?i)" + r"|(\s|#|@)".join(sample.pooled_list()) + "'"


@query(f"""SELECT doc_id, regexp_matches(text, {POOLED}) AS strict, regexp_matches(text, {COMPAT}) AS compat
FROM documents""")
def matches_terms(spark, sf_dir):
    text, terms = F.col("text"), sample.pooled_list()
    return sample.documents(spark, sf_dir).select(
        "doc_id", tx.matches_terms(text, terms).alias("strict"),
        tx.matches_terms(text, terms, "compat").alias("compat"),
    )


@query(f"WITH {sample.tagged_sql()} SELECT batchtime, text FROM tagged WHERE first_term = 'orre'")
def by_entity(spark, sf_dir):
    return ps.by_entity(sample.tagged_posts(spark, sf_dir), "orre")


@query("""SELECT event_id, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%H:%M:%S') AS local
FROM events WHERE strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%H:%M:%S')
  BETWEEN '20:30:00' AND '23:00:00'""")
def time_of_day(spark, sf_dir):
    local = tm.to_local(tm.utc_instant(F.col("ts")))
    return ps.time_of_day(sample.table(spark, sf_dir, "events"), local, "20:30:00", "23:00:00").select(
        "event_id", tm.time_of_day(local).alias("local")
    )


@query("SELECT DISTINCT lang, source, text FROM documents")
def dedupe_posts(spark, sf_dir):
    return ps.dedupe_posts(sample.documents(spark, sf_dir).select("lang", "source", "text"))


def documents_as_posts(spark, sf_dir):
    return sample.documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text", "source")


@query(f"""WITH d AS (SELECT doc_id AS id, text, source FROM documents)
SELECT 'all' AS party, id, array_to_string({sample.hits_sql()}, '|') AS search_terms FROM d UNION ALL
SELECT 'south', id, array_to_string({sample.hits_sql('south')}, '|') FROM d UNION ALL
SELECT 'all+tags', id, array_to_string({sample.hits_sql(text="text || ' #' || replace(source, 'src1', 'orre')")}, '|') FROM d""")
def tag_entities(spark, sf_dir):
    posts, terms = documents_as_posts(spark, sf_dir), sample.terms(spark)
    tags = F.array(F.replace("source", F.lit("src1"), F.lit("orre")))
    kinds = {
        "all": ps.tag_entities(posts, terms),
        "south": ps.tag_entities(posts, terms, "south"),
        "all+tags": ps.tag_entities(posts.withColumn("hashtags", tags), terms, include_hashtags=True),
    }
    out = [
        df.select(F.lit(name).alias("party"), "id", F.array_join("search_terms", "|").alias("search_terms"))
        for name, df in kinds.items()
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(f"""WITH d AS (SELECT doc_id AS id, text FROM documents)
SELECT id, array_to_string({sample.hits_sql()}, '|') AS search_terms, regexp_matches(text, {POOLED}) AS mentioning FROM d""")
def tag_entities_joined(spark, sf_dir):
    """The same tagging by join, as for a dictionary too large for patterns."""
    posts, terms = documents_as_posts(spark, sf_dir), sample.terms(spark)
    any_term = mentions.mentioning(posts, terms).select("id", F.lit(True).alias("found"))
    return mentions.tag_entities_joined(posts, terms).join(any_term, "id", "left").select(
        "id", F.array_join("search_terms", "|").alias("search_terms"),
        F.coalesce("found", F.lit(False)).alias("mentioning"),
    )


@query(f"WITH {sample.tagged_sql()} SELECT id, first_term, multiple_terms FROM tagged")
def primary_entity(spark, sf_dir):
    return sample.tagged_posts(spark, sf_dir).select("id", "first_term", "multiple_terms")


INDICATORS = ", ".join(
    f"CAST(regexp_matches(text, {sample.pattern_sql(found)}) AS INT) AS is_{entity}"
    for _, entity, found in sample.entity_list()
)


@query(f"SELECT doc_id AS id, {INDICATORS} FROM documents")
def entity_indicators(spark, sf_dir):
    posts = documents_as_posts(spark, sf_dir)
    return ps.entity_indicators(posts, sample.terms(spark)).drop("text", "source")


EXACT = ("ononst",)


def _owner_sql(opening: str) -> str:
    cases = " ".join(
        f"WHEN {f'w = {chr(39)}{t}{chr(39)}' if t in EXACT else f'contains(w, {chr(39)}{t}{chr(39)})'} THEN '{entity}'"
        for _, entity, found in sample.entity_list() for t in found
    )
    words = f"list_filter(string_split_regex(lower({opening}), '\\s+'), lambda w: w <> '')"
    owners = f"list_filter(list_transform({words}, lambda w: CASE {cases} END), lambda x: x IS NOT NULL)"
    return f"coalesce({owners}[1], 'general')"


ENTITY_DOCS = f"""entity_docs AS (SELECT doc_id, {_owner_sql('substr(text, 1, 200)')} AS entity,
  {_owner_sql('text')} AS entity_whole FROM documents)"""


def documents_with_entity(spark, sf_dir, chars: int | None = 200):
    docs = sample.documents(spark, sf_dir).select("doc_id", "text")
    return ps.entity_from_prefix(docs, sample.terms(spark), chars, exact=EXACT)


@query(f"WITH {ENTITY_DOCS} SELECT doc_id, entity, entity_whole FROM entity_docs")
def entity_from_prefix(spark, sf_dir):
    opening = documents_with_entity(spark, sf_dir).withColumnRenamed("entity", "by_opening")
    whole = ps.entity_from_prefix(opening, sample.terms(spark), chars=None, exact=EXACT)
    return whole.select("doc_id", F.col("by_opening").alias("entity"), F.col("entity").alias("entity_whole"))
