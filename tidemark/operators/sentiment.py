"""Lexicon scoring, entity summaries and interval profiles.

Posts come in as ``(id, text, ...)`` with ASCII text; ``id`` identifies a post.
The lexicon is ``(word, score)``. No join carries a broadcast hint: the planner
broadcasts the lexicon when its known size is below the session's threshold and
falls back to a shuffled join with skew splitting when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions import times as tm
from tidemark.session import explode_words, store
from tidemark.sources.readers import GENERAL, select_party

NEUTRAL = 5.0
SCORE_DIGITS = 9  # post scores closer than this tie, whatever order they were summed in


# ---------------------------------------------------------------- tokens


def post_tokens(posts: DataFrame, *keep: str) -> DataFrame:
    """One row per token with its position; a post without tokens keeps one empty row."""
    return posts.select(*keep, F.posexplode_outer(tx.word_tokens(F.col("text"))).alias("pos", "word"))


def _first_token() -> Column:
    """True on exactly one token row of every post row."""
    return F.col("pos").isNull() | (F.col("pos") == 0)


def lexicon_join(tokens: DataFrame, lexicon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tokens split into ``(scored, unused)``."""
    real = tokens.filter(F.col("word").isNotNull())
    return real.join(lexicon, "word"), real.join(lexicon, "word", "left_anti")


def scored_tokens(posts: DataFrame, lexicon: DataFrame, *keep: str) -> DataFrame:
    """Every token with its score, null where the lexicon lacks it."""
    return post_tokens(posts, *keep).join(lexicon, "word", "left")


# ---------------------------------------------------------------- per post


def score_posts(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Mean, population deviation and word counts per post.

    All tokens of a post sit in one partition, so the partial aggregate leaves
    one narrow row per post before the shuffle; the text itself is not moved.
    """
    counted = posts.select("id", "text", tx.raw_word_count(F.col("text")).alias("total_word_ct"))
    return (
        scored_tokens(counted, lexicon, "id", "total_word_ct")
        .groupBy("id", "total_word_ct")
        .agg(
            F.avg("score").alias("score_avg"),
            F.stddev_pop("score").alias("score_std"),
            F.count("score").alias("words_used"),
        )
        .withColumn("prop_words_used", F.col("words_used") / F.col("total_word_ct"))
    )


def scored_only(scored: DataFrame) -> DataFrame:
    """Drop posts without any lexicon word."""
    return scored.filter(F.col("score_avg").isNotNull())


# ---------------------------------------------------------------- per entity and interval


def count_by_entity(posts: DataFrame) -> DataFrame:
    """Posts per interval and first entity."""
    return posts.groupBy("batchtime", "first_term").agg(F.count(F.lit(1)).alias("num_posts"))


def pooled_sentiment(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Token-weighted mean and deviation per interval and first entity."""
    return (
        scored_tokens(posts, lexicon, "batchtime", "first_term")
        .groupBy("batchtime", "first_term")
        .agg(F.avg("score").alias("sentiment_avg"), F.stddev_pop("score").alias("sentiment_std"))
    )


def post_moments(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Per post: rows seen, scored tokens, and sums of the score's distance from neutral."""
    distance = F.col("score") - NEUTRAL
    return (
        scored_tokens(posts, lexicon, "batchtime", "first_term", "id")
        .groupBy("batchtime", "first_term", "id")
        .agg(
            F.count_if(_first_token()).alias("n_rows"),
            F.count("score").alias("n_words"),
            F.sum(distance).alias("sum_d"),
            F.sum(distance * distance).alias("sum_dd"),
        )
    )


def summary_numbers(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Mergeable numbers per interval and entity, with the ids of the extreme posts.

    The extremes are found on narrow per-post rows (score and id); no text takes
    part in the aggregation.
    """
    score = F.round(NEUTRAL + F.col("sum_d") / F.col("n_words"), SCORE_DIGITS)
    scored = F.col("n_words") > 0
    return (
        post_moments(posts, lexicon)
        .groupBy("batchtime", "first_term")
        .agg(
            F.sum("n_rows").alias("num_posts"),
            F.sum(F.when(scored, F.col("n_rows"))).alias("num_scored"),
            F.sum("n_words").alias("n_words"),
            F.sum("sum_d").alias("sum_d"),
            F.sum("sum_dd").alias("sum_dd"),
            F.max(F.when(scored, F.struct(score.alias("score"), (-F.col("id")).alias("neg_id")))).alias("hi"),
            F.min(F.when(scored, F.struct(score.alias("score"), F.col("id").alias("id")))).alias("lo"),
        )
        .select(
            "batchtime", "first_term", "num_posts", F.coalesce("num_scored", F.lit(0)).alias("num_scored"),
            "n_words", "sum_d", "sum_dd",
            F.col("hi.score").alias("high_score"), (-F.col("hi.neg_id")).alias("high_id"),
            F.col("lo.score").alias("low_score"), F.col("lo.id").alias("low_id"),
        )
    )


def with_extreme_texts(numbers: DataFrame, posts: DataFrame) -> DataFrame:
    """Add the texts of the extreme posts, looked up by id.

    ``numbers`` feeds both sides of a join, so it should be stored or persisted;
    its size is then known, and its ids are broadcast rather than every text
    shuffled as long as they stay below the session's broadcast threshold.
    """
    ends = F.array(
        F.struct(F.lit(True).alias("is_high"), F.col("high_id").alias("id")),
        F.struct(F.lit(False).alias("is_high"), F.col("low_id").alias("id")),
    )
    texts = (
        posts.select("id", "text")
        .join(numbers.select("batchtime", "first_term", F.inline(ends)), "id")
        .groupBy("batchtime", "first_term")
        .agg(
            F.min(F.when(F.col("is_high"), F.col("text"))).alias("high_text"),
            F.min(F.when(~F.col("is_high"), F.col("text"))).alias("low_text"),
        )
    )
    return numbers.join(texts, ["batchtime", "first_term"], "left")


def partial_summary(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Mergeable summary per interval and entity. The numbers are computed once and stored."""
    return with_extreme_texts(store(summary_numbers(posts, lexicon), "summary-numbers"), posts)


def merge_summaries(partials: DataFrame) -> DataFrame:
    """Partial summaries of several batches merged exactly, one row per interval and entity."""
    high = F.when(F.col("num_scored") > 0, F.struct("high_score", (-F.col("high_id")).alias("neg"), "high_text"))
    low = F.when(F.col("num_scored") > 0, F.struct("low_score", "low_id", "low_text"))
    return (
        partials.groupBy("batchtime", "first_term")
        .agg(
            *[F.sum(c).alias(c) for c in ("num_posts", "num_scored", "n_words", "sum_d", "sum_dd")],
            F.max(high).alias("hi"),
            F.min(low).alias("lo"),
        )
        .select(
            "batchtime", "first_term", "num_posts", "num_scored", "n_words", "sum_d", "sum_dd",
            "hi.high_score", (-F.col("hi.neg")).alias("high_id"), "hi.high_text",
            "lo.low_score", "lo.low_id", "lo.low_text",
        )
    )


def finish_summary(partial: DataFrame) -> DataFrame:
    """Mean, deviation and extremes (from two scored posts on) of merged partial rows."""
    mean_d = F.col("sum_d") / F.col("n_words")
    mean_dd = F.col("sum_dd") / F.col("n_words")
    variance = mean_dd - mean_d * mean_d
    # what is left after cancellation below the sums' own precision is no spread
    spread = F.when(variance > mean_dd * 1e-12, F.sqrt(variance)).otherwise(F.lit(0.0))
    has_words = F.col("n_words") > 0
    enough = F.col("num_scored") >= 2
    return partial.select(
        "batchtime",
        "first_term",
        "num_posts",
        F.when(has_words, NEUTRAL + mean_d).alias("sentiment_avg"),
        F.when(has_words, spread).alias("sentiment_std"),
        *[
            F.when(enough, F.col(c)).alias(c)
            for c in ("high_score", "high_id", "high_text", "low_score", "low_id", "low_text")
        ],
    )


def extreme_posts(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Highest and lowest scoring post per interval and entity, null below two scored posts."""
    return finish_summary(partial_summary(posts, lexicon)).select(
        "batchtime", "first_term", "high_score", "high_id", "high_text", "low_score", "low_id", "low_text"
    )


def entities_with_general(terms: DataFrame, party: str | None) -> DataFrame:
    """``(first_term, party)`` rows of the dictionary plus the ``general`` entity.

    An unknown party is an error.
    """
    named = select_party(terms, party).select(F.col("entity").alias("first_term"), "party").distinct()
    if named.isEmpty():
        raise ValueError(f"no terms for party {party!r}")
    general = named.sparkSession.range(1).select(F.lit(GENERAL).alias("first_term"), F.lit(GENERAL).alias("party"))
    return named.unionByName(general)


def zero_fill(counts: DataFrame, entities: DataFrame, zeros: tuple[str, ...] = ("num_posts",)) -> DataFrame:
    """Every entity in every interval seen; the absent ones report 0 in the ``zeros`` columns.

    ``entities`` has ``first_term`` and ``party``. The rows of an interval, at most one
    per entity, are gathered once; the names missing among them, found as a difference
    of two lists, are put beside them. So ``counts`` is computed once and not joined
    with itself, and an interval costs as much as it has entities.
    """
    values = [c for c in counts.columns if c not in ("batchtime", "first_term")]
    names = entities.agg(F.collect_set("first_term").alias("names")).scalar()
    gathered = counts.groupBy("batchtime").agg(F.collect_list(F.struct("first_term", *values)).alias("rows"))
    kinds = dict(counts.dtypes)
    absent = F.transform(
        F.array_except("names", F.transform("rows", lambda row: row["first_term"])),
        lambda name: F.struct(
            name.alias("first_term"), *[F.lit(0 if c in zeros else None).cast(kinds[c]).alias(c) for c in values]
        ),
    )
    filled = gathered.withColumn("names", names).select("batchtime", F.inline(F.concat("rows", absent)))
    return filled.join(entities, "first_term").select("batchtime", "first_term", "party", *values)


def entity_summary(
    posts: DataFrame, lexicon: DataFrame, terms: DataFrame, party: str | None = None
) -> DataFrame:
    """Count, sentiment and extremes per interval for every entity, silent ones included."""
    summary = finish_summary(partial_summary(posts, lexicon))
    return zero_fill(summary, entities_with_general(terms, party))


# ---------------------------------------------------------------- historic analysis


def interval_profile(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Posts, words, share of scored words, mean and deviation per interval and entity, in one aggregation."""
    counted = posts.select(
        "batchtime", "first_term", "text", tx.raw_word_count(F.col("text")).alias("words")
    )
    return (
        scored_tokens(counted, lexicon, "batchtime", "first_term", "words")
        .groupBy("batchtime", "first_term")
        .agg(
            F.count_if(_first_token()).alias("count"),
            F.sum(F.when(_first_token(), F.col("words"))).alias("total_word_ct"),
            F.count("score").alias("scored_words"),
            F.avg("score").alias("sentiment_avg"),
            F.stddev_pop("score").alias("sentiment_std"),
        )
        .withColumn("prop_words_scored", F.col("scored_words") / F.col("total_word_ct"))
        .drop("scored_words")
    )


def profile_join(scores: DataFrame, counts: DataFrame) -> DataFrame:
    """Scores and counts of the same intervals and entities side by side, matched on their keys."""
    return scores.join(counts, ["batchtime", "first_term"])


def count_series(posts: DataFrame) -> DataFrame:
    """Posts per entity and interval, in a frame ready for plotting by entity."""
    return posts.groupBy("first_term", "batchtime").agg(F.count(F.lit(1)).alias("count"))


def distinct_entities(posts: DataFrame) -> DataFrame:
    return posts.select("first_term").distinct()


def minute_histogram(posts: DataFrame, ts: str = "ts", zone: str = tm.NEW_YORK, wrap: str | None = "minus_one") -> DataFrame:
    """Posts per minute of the local hour.

    ``wrap='minus_one'`` shows minute 59 as -1 (posts just before the hour);
    ``wrap='clock'`` labels minutes 29-59 as 829-859 and 0-28 as 860-888, for a
    window that starts at half past eight.
    """
    minute = F.minute(tm.to_local(F.col(ts), zone).cast("timestamp_ntz"))
    if wrap == "minus_one":
        label = F.when(minute == 59, F.lit(-1)).otherwise(minute)
    elif wrap == "clock":
        label = F.when(minute > 28, minute + 800).otherwise(minute + 860)
    else:
        label = minute
    return posts.groupBy(label.alias("minute")).agg(F.count(F.lit(1)).alias("count"))


def lexicon_coverage(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Distinct scored words over distinct raw words per entity.

    Each post sends its distinct raw pieces and tokens once, in one pass over the
    texts. Words are then reduced per (entity, word), so a dominant entity spreads
    over its words instead of filling one task.
    """

    def marked(words: Column, is_token: bool) -> Column:
        return F.transform(
            F.array_distinct(words), lambda w: F.struct(F.lit(is_token).alias("is_token"), w.alias("word"))
        )

    text = F.col("text")
    words = F.concat(marked(F.split(text, " ", -1), False), marked(tx.word_tokens(text), True))
    return (
        explode_words(posts, ["first_term"], words, name="w").select("first_term", "w.*")
        .groupBy("first_term", "is_token", "word").agg(F.lit(1).alias("seen"))
        .join(lexicon, "word", "left")
        .groupBy("first_term")
        .agg(
            F.count_if(~F.col("is_token")).alias("raw_words"),
            F.count_if(F.col("is_token") & F.col("score").isNotNull()).alias("used_words"),
        )
        .withColumn("coverage", F.col("used_words") / F.col("raw_words"))
    )


def scored_words(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    return lexicon_join(post_tokens(posts, "first_term"), lexicon)[0]


def extreme_words(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Highest and lowest scoring word used per entity; ties go to the first in the alphabet."""
    words = scored_words(posts, lexicon).groupBy("first_term", "word", "score").agg(F.count(F.lit(1)).alias("n"))
    high = F.min(F.struct((-F.col("score")).alias("key"), "word"))
    low = F.min(F.struct("score", "word"))
    return (
        words.groupBy("first_term")
        .agg(high.alias("hi"), low.alias("lo"))
        .select(
            "first_term",
            F.col("hi.word").alias("high_word"), (-F.col("hi.key")).alias("high_score"),
            F.col("lo.word").alias("low_word"), F.col("lo.score").alias("low_score"),
        )
    )


def score_histogram(posts: DataFrame, lexicon: DataFrame, bins: int = 15) -> DataFrame:
    """Equal-width bins of each entity's word scores; the top edge belongs to the last bin.

    Scores are counted per (entity, score) first: there are no more of those than
    lexicon scores, however many tokens an entity has.
    """
    counts = scored_words(posts, lexicon).groupBy("first_term", "score").agg(F.count(F.lit(1)).alias("n"))
    entity = Window.partitionBy("first_term")
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.floor((F.col("score") - F.col("lo")) / width).cast("int")
    return (
        counts.withColumns({"lo": F.min("score").over(entity), "hi": F.max("score").over(entity)})
        .withColumn("bin", F.when(width > 0, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)))
        .groupBy("first_term", "bin")
        .agg(F.sum("n").alias("count"))
    )


def batch_row_counts(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Posts before and after dropping the unscored ones, per interval and entity."""
    return (
        post_moments(posts, lexicon)
        .groupBy("batchtime", "first_term")
        .agg(
            F.sum("n_rows").alias("rows_in"),
            F.sum(F.when(F.col("n_words") > 0, F.col("n_rows")).otherwise(0)).alias("rows_scored"),
        )
    )
