"""Raw post JSON to flat, eligible, tagged posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import text as tx
from tidemark.functions import times as tm
from tidemark.operators import mentions
from tidemark.session import explode_words, rows_if_small, spare_names, store
from tidemark.sources.readers import GENERAL, pool_terms, select_party

MAX_PATTERN_TERMS = 64  # beyond this, a dictionary goes into an automaton instead of patterns
MAX_INDICATORS = 2_000  # columns

# ---------------------------------------------------------------- decoding


def parse_posts(raw: DataFrame, value: str = "value") -> DataFrame:
    """Raw JSON text as the post's fields, the line itself and whether it is a dead letter.

    Lines that are blank or not a JSON object are dead. Where both kinds are used,
    store or persist this table and take them from it, so that a line is parsed once.
    The parsed struct is opened with ``inline`` so that later filters cannot be
    pushed below it and make Spark parse every line twice.
    """
    line = F.col(value).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    parsed = raw.select(
        line.alias("_line"), F.inline_outer(F.array(F.from_json(line, schemas.RAW_POST, options)))
    )
    bad = (F.col(schemas.CORRUPT).isNotNull()) | F.coalesce(F.trim("_line") == "", F.lit(True))
    return parsed.withColumn("_dead", bad).drop(schemas.CORRUPT)


def good_posts(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("_dead")).drop("_line", "_dead")


def dead_letters(parsed: DataFrame, value: str = "value") -> DataFrame:
    """The dead lines as they came."""
    return parsed.filter("_dead").select(F.col("_line").alias(value))


def decode_posts(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Raw JSON text as ``(posts, dead letters)``; for use of one of the two, see ``parse_posts``."""
    parsed = parse_posts(raw, value)
    return good_posts(parsed), dead_letters(parsed, value)


# ---------------------------------------------------------------- filters


def _yes(condition: Column) -> Column:
    """A missing field fails the filter instead of passing it."""
    return F.coalesce(condition, F.lit(False))


def _no_links(posts: DataFrame) -> Column:
    return F.size("entities.urls") == 0


def eligible_posts(
    posts: DataFrame, terms: DataFrame, mode: str = "strict", check_limit: bool = True
) -> DataFrame:
    """Original English posts without links or media that mention a tracked term.

    A dictionary of many terms is matched as ``tag_entities`` does it; the result is the
    same.
    """
    keep = (
        F.col("delete").isNull()
        & F.col("retweeted_status").isNull()
        & _yes(F.col("lang") == "en")
        & _yes(_no_links(posts))
        & F.col("entities.media").isNull()
    )
    if check_limit:
        keep = keep & F.col("limit").isNull()
    pooled = rows_if_small(pool_terms(terms), MAX_PATTERN_TERMS)
    if pooled is None:
        order = F.struct(F.col("entity") == GENERAL, "entity_pos", "term_pos")
        pool = terms.select(F.lit(0).alias("entity_pos"), F.lit(GENERAL).alias("entity"), "term", order.alias("term_pos"))
        if mode != "strict":
            (hits,) = spare_names(posts, "_hits")
            return mentions.with_hits(posts.filter(keep), F.col("text"), pool, mode, hits).filter(F.size(hits) > 0).drop(hits)
        find = mentions.finder(pool)
        return mentions.mentioning(posts.filter(keep), terms) if find is None else posts.filter(keep).filter(F.size(find(F.col("text"))) > 0)
    return posts.filter(keep & _yes(tx.matches_terms(F.col("text"), [r.term for r in pooled], mode)))


def eligible_geo(posts: DataFrame, needle: str | None = None) -> DataFrame:
    """Original posts by English-language users whose place is known.

    With ``needle`` the text must hold it in any case and the place must not be
    empty; media are then allowed. Without it, posts with media are dropped.
    """
    geo, location = F.col("geo"), F.col("user.location")
    keep = (
        F.col("retweeted_status").isNull()
        & _yes(F.col("user.lang") == "en")
        & _yes(_no_links(posts))
    )
    if needle is None:
        keep = keep & (geo.isNotNull() | location.isNotNull()) & F.col("entities.media").isNull()
    else:
        keep = keep & _yes((F.length(geo) > 0) | (F.length(location) > 0))
        keep = keep & _yes(F.contains(F.lower("text"), F.lit(needle.lower())))
    return posts.filter(keep)


def eligible_media_without_url(posts: DataFrame) -> DataFrame:
    """Original posts without links whose media items carry no url."""
    media = F.col("entities.media")
    return posts.filter(
        F.col("text").isNotNull()
        & F.col("retweeted_status").isNull()
        & _yes(_no_links(posts))
        & (media.isNull() | F.forall(media, lambda m: m["url"].isNull()))
    )


def by_entity(tagged: DataFrame, entity: str) -> DataFrame:
    """Batch time and text of the posts whose first entity is ``entity``."""
    return tagged.sparkSession.sql(
        "SELECT batchtime, text FROM {tweets} WHERE first_term = :entity",
        args={"entity": entity}, tweets=tagged,
    )


def time_of_day(df: DataFrame, local: Column, start: str, end: str) -> DataFrame:
    """Rows whose wall-clock time lies in the closed range ``HH:mm:ss`` .. ``HH:mm:ss``."""
    return df.filter(tm.time_of_day(local).between(start, end))


def dedupe_posts(posts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Repeated rows once; on a stream, within the watermark."""
    if posts.isStreaming:
        return posts.dropDuplicatesWithinWatermark(keys)
    return posts.dropDuplicates(keys)


# ---------------------------------------------------------------- tagging


def entity_terms(terms: DataFrame, party: str | None) -> list[tuple[str, list[str]]] | None:
    """``(entity, its terms)`` in dictionary order, None when there are too many to write out.

    An unknown party is an error.
    """
    rows = rows_if_small(
        select_party(terms, party).select("entity", "entity_pos", "term", "term_pos"), MAX_PATTERN_TERMS
    )
    if rows is None:
        return None
    if not rows:
        raise ValueError(f"no terms for party {party!r}")
    grouped: dict[tuple[int, str], list] = {}
    for row in rows:
        grouped.setdefault((row.entity_pos, row.entity), []).append((row.term_pos, row.term))
    return [(entity, [t for _, t in sorted(found)]) for (_, entity), found in sorted(grouped.items())]


def _with_hashtags() -> Column:
    """The text followed by its hashtags, each after `` #``."""
    tags = F.transform("hashtags", lambda h: F.concat(F.lit(" #"), h))
    return F.concat("text", F.array_join(tags, ""))


def tag_entities(
    posts: DataFrame, terms: DataFrame, party: str | None = None, mode: str = "strict",
    include_hashtags: bool = False,
) -> DataFrame:
    """Add ``search_terms``: every entity the text mentions, else ``['general']``.

    Few terms become one pattern per entity; more go into one automaton that reads a
    text once, whatever the number of terms and entities. Either way tagging is a
    narrow projection: no join, no shuffle, whatever the entity mix. Only a dictionary
    too large to be sent to every task is joined instead, on a hash of the text. In
    compat mode many terms are matched as one array value. The result is the same.
    """
    entities = entity_terms(terms, party)
    searched = _with_hashtags() if include_hashtags else F.col("text")
    if entities is None:
        named = select_party(terms, party)
        find = mentions.finder(named) if mode == "strict" else None
        if mode == "strict" and find is None:
            return mentions.tag_entities_joined(posts, terms, party, searched)
        (hits,) = spare_names(posts, "_hits")
        if find is None:
            found = mentions.with_hits(posts, searched, named, mode, hits).withColumn(hits, F.col(f"{hits}.entity"))
        else:
            found = posts.withColumn(hits, find(searched))
        return found.withColumn("search_terms", _or_general(F.col(hits))).drop(hits)
    flags = dict(zip(spare_names(posts, *[f"_hit_{i}" for i in range(len(entities))]), entities, strict=True))
    tagged = posts.withColumns({f: tx.matches_terms(searched, found, mode) for f, (_, found) in flags.items()})
    named = F.array_compact(F.array(*[F.when(F.col(f), F.lit(e)) for f, (e, _) in flags.items()]))
    return tagged.withColumn("search_terms", named).withColumn("search_terms", _or_general(F.col("search_terms"))).drop(*flags)


def _or_general(names: Column) -> Column:
    return F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(GENERAL)))


def primary_entity(tagged: DataFrame) -> DataFrame:
    """Add ``first_term`` and ``multiple_terms``.

    ``first_term`` is written so that it cannot be null: joins on it then add no
    null filter, which Spark would push down to a second evaluation of the patterns.
    """
    return tagged.withColumn(
        "first_term", F.coalesce(F.get("search_terms", F.lit(0)), F.lit(GENERAL))
    ).withColumn("multiple_terms", F.size("search_terms") > 1)


def entity_indicators(
    posts: DataFrame, terms: DataFrame, party: str | None = None, mode: str = "strict"
) -> DataFrame:
    """One 0/1 column ``is_<entity>`` per entity of the dictionary, whatever its number of terms.

    More than ``MAX_INDICATORS`` entities are refused: a table has no room for them.
    """
    entities = entity_terms(terms, party)
    if entities is None:
        names = rows_if_small(
            select_party(terms, party).select("entity", "entity_pos").distinct().orderBy("entity_pos", "entity"),
            MAX_INDICATORS,
        )
        if names is None:
            raise ValueError(f"more than {MAX_INDICATORS} entities for a column each; use tag_entities")
        tagged = tag_entities(posts, terms, party, mode)
        return tagged.select(
            *posts.columns,
            *[F.array_contains("search_terms", r.entity).cast("int").alias(f"is_{r.entity}") for r in names],
        )
    return posts.select(
        "*",
        *[
            _yes(tx.matches_terms(F.col("text"), found, mode)).cast("int").alias(f"is_{entity}")
            for entity, found in entities
        ],
    )


def entity_from_prefix(
    docs: DataFrame, terms: DataFrame, chars: int | None = 200, exact: tuple[str, ...] = ("rand",)
) -> DataFrame:
    """Add ``entity``: that of the first word holding a term, else ``general``.

    Only the opening ``chars`` characters decide, all with None. Terms listed in
    ``exact`` must equal the word, all others may be any part of it. Of several terms in
    a word the first of the dictionary counts. Each different word is looked up once,
    through an index of the terms by runs of characters, so neither a document nor a word
    is held against the whole dictionary.
    """
    rows = select_party(terms, None).select("entity_pos", "term_pos", F.lower("term").alias("term"), "entity")
    opening = F.col("text") if chars is None else F.substring("text", 1, chars)
    key, named = spare_names(docs, "_opening_key", "_named")
    keyed = docs.withColumn(key, F.sha2(opening, 256))
    texts = keyed.select(F.col(key).alias("key"), tx.whitespace_words(F.lower(opening)).alias("words"))
    places = explode_words(texts, ["key"], F.col("words"), "pos")
    found = mentions.words_holding(places.select("word").distinct(), rows)
    found = found.filter(~F.col("term").isin(*exact) | (F.col("word") == F.col("term")))
    owners = found.groupBy("word").agg(F.min(F.struct("entity_pos", "term_pos", "term", "entity")).alias("first"))
    owners = store(owners.select("word", F.col("first.entity").alias("entity")), "word-owners")
    first = places.join(owners, "word").groupBy(F.col("key").alias(key)).agg(F.min(F.struct("pos", "entity")).alias(named))
    out = keyed.join(first, key, "left")
    entity = F.coalesce(F.col(f"{named}.entity"), F.lit(GENERAL)).alias("entity")
    return out.select(*[c for c in docs.columns if c != "entity"], entity)


# ---------------------------------------------------------------- projection


def project_fields(
    posts: DataFrame, terms: DataFrame, party: str | None = None, mode: str = "strict",
    seconds: int = 30, batch_ts: Column | None = None,
) -> DataFrame:
    """Eligible raw posts as tagged records.

    ``batchtime`` is the interval of the post's own time, or of ``batch_ts``
    where a processing-time interval is wanted. Entities are looked up in the
    original text; the stored text and hashtags are ASCII only.
    """
    ts = tm.parse_created_at(F.col("created_at"))
    tagged = primary_entity(tag_entities(posts, terms, party, mode))
    return tagged.select(
        "id",
        tm.wall_text(tm.utc_wall_clock(ts)).alias("timestamp"),
        tm.floor_interval(ts if batch_ts is None else batch_ts, seconds).alias("batchtime"),
        F.col("user.screen_name").alias("username"),
        tx.ascii_only(F.col("text")).alias("text"),
        F.transform(tx.hashtag_texts(F.col("entities.hashtags")), tx.ascii_only).alias("hashtags"),
        "first_term",
        "search_terms",
        "multiple_terms",
    )


def project_geo_fields(posts: DataFrame, jq_names: bool = False) -> DataFrame:
    """Flat records with place fields, under the plain or the short-form names."""
    tags = tx.hashtag_texts(F.col("entities.hashtags"))
    if jq_names:
        return posts.select(
            F.col("created_at").alias("timestamp"),
            F.col("user.screen_name").alias("screename"),
            F.col("user.location").alias("location"),
            "geo",
            F.col("text").alias("tweet"),
            tx.joined_with_trailing_comma(tags).alias("hashtags"),
        )
    return posts.select(
        "id",
        F.col("created_at").alias("timestamp"),
        F.col("user.screen_name").alias("username"),
        "text",
        tags.alias("hashtags"),
        F.col("geo").alias("geotag"),
        F.col("user.location").alias("user_loc"),
    )


def typed_rows(records: DataFrame, with_batchtime: bool = True) -> DataFrame:
    """The records under the fixed table schema; missing hashtags become an empty list."""
    columns = [part.strip().split(" ") for part in schemas.TAGGED_POST.split(",")]
    out = []
    for name, kind in columns:
        if name == "batchtime" and not with_batchtime:
            continue
        col = F.col(name)
        if name == "hashtags":
            col = F.coalesce(col, F.array().cast("array<string>"))
        out.append(col.cast(kind).alias(name))
    return records.select(*out)


def record_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Each record as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias(name))
