"""The result store: summary items, range reads, chart series and the event registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.session import number_in_order
from tidemark.sources.writers import DAY


def summary_items(summary: DataFrame) -> DataFrame:
    """Store items ``(item, name, value)``: key ``entity_interval``, three attributes each.

    The attribute and field names are fixed: they are what readers of the store expect.
    The data attribute is the summary as a JSON object of texts, with the extremes
    in the ``score_text`` form and blanks where there is nothing.
    """

    def text(col: Column) -> Column:
        return F.coalesce(col.cast("string"), F.lit(""))

    data = F.to_json(
        F.struct(
            text(F.col("party")).alias("party"),
            text(F.col("batchtime")).alias("batchtime"),
            text(F.col("num_posts")).alias("num_tweets"),
            text(F.col("sentiment_avg")).alias("sentiment_avg"),
            text(F.col("sentiment_std")).alias("sentiment_std"),
            F.concat(text(F.col("high_score")), F.lit("_"), text(F.col("high_text"))).alias("highest_sentiment_tweet"),
            F.concat(text(F.col("low_score")), F.lit("_"), text(F.col("low_text"))).alias("lowest_sentiment_tweet"),
        )
    )
    return _items(summary, data)


def profile_items(profile: DataFrame) -> DataFrame:
    """Store items of an interval profile; numbers stay numbers in the data attribute."""
    data = F.to_json(
        F.struct("count", "total_word_ct", "prop_words_scored", "sentiment_avg", "sentiment_std"),
        {"ignoreNullFields": "false"},
    )
    return _items(profile, data)


def _items(rows: DataFrame, data: Column) -> DataFrame:
    batch = F.col("batchtime").cast("string")
    return rows.select(
        F.concat_ws("_", "first_term", batch).alias("item"),
        data.alias("data"), batch.alias("timestamp"), F.col("first_term").alias("candidate"),
    ).unpivot("item", ["data", "timestamp", "candidate"], "name", "value")


def eav_pivot(eav: DataFrame, names: list[str], id_col: str = "item") -> DataFrame:
    """Attribute rows as one wide row per item.

    The names are given, so no pass is spent on finding them. A repeated attribute
    keeps its greatest value.
    """
    return eav.groupBy(id_col).pivot("name", names).agg(F.max("value"))


def summary_range(results: DataFrame, start: int, end: int = 0) -> DataFrame:
    """Rows of the closed time range, or of exactly ``start`` when ``end`` is not positive.

    Results stored by day are read from the days of the range only.
    """
    last = end if end > 0 else start
    rows = results.filter(F.col("timestamp").between(start, last))
    if "day" in results.columns:
        rows = rows.filter(F.col("day").between(start // DAY, last // DAY))
    return rows


def latest_closed_interval(results: DataFrame, now: int, seconds: int = 30) -> DataFrame:
    """Rows of the last interval that was complete at ``now``."""
    return summary_range(results, now - now % seconds - seconds)


def initial_then_full(results: DataFrame, start: int, end: int, initial: int = 1200) -> DataFrame:
    """The opening slice of a range and then all of it, told apart by ``phase``."""
    return (
        summary_range(results, start, start + initial).withColumn("phase", F.lit("initial"))
        .unionByName(summary_range(results, start, end).withColumn("phase", F.lit("full")))
    )


def time_bounds(results: DataFrame) -> DataFrame:
    """First and last interval of a result set."""
    return results.agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


def series_points(items: DataFrame, offset_ms: int = 0, digits: int = 2) -> DataFrame:
    """Chart points ``(entity, x, y, std)`` of wide items.

    ``NaN`` in the stored JSON reads as missing; means and deviations that are not
    positive are missing too, the others are rounded.
    """
    data = F.from_json(F.regexp_replace("data", r"\bNaN\b", "null"), schemas.SUMMARY_DATA)

    def shown(name: str) -> Column:
        value = data[name]
        return F.when(value > 0, F.round(value.cast("decimal(28,10)"), digits).cast("double"))

    return items.select(
        F.col("candidate").alias("entity"),
        (F.col("timestamp").cast("long") * 1000 + offset_ms).alias("x"),
        shown("sentiment_avg").alias("y"),
        shown("sentiment_std").alias("std"),
    )


def entity_series(points: DataFrame, day_ms: int = 86_400_000) -> DataFrame:
    """Ordered points as one array per entity and day.

    A day holds a fixed number of intervals, so no array grows with the data.
    """
    day = (F.col("x") - F.pmod("x", F.lit(day_ms))).alias("day")
    return points.groupBy("entity", day).agg(
        F.sort_array(F.collect_list(F.struct("x", "y", "std"))).alias("points")
    )


def append_series(master: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh points appended to the known entities.

    A new entity is taken in only if its first point has a value. With no series
    yet, everything fresh is taken.
    """
    if master.isEmpty():
        return fresh
    first = fresh.groupBy("entity").agg(F.min_by("y", "x").alias("first_y"))
    starts_well = first.filter(F.col("first_y").isNotNull() & ~F.isnan("first_y")).select("entity")
    welcome = master.select("entity").unionByName(starts_well).distinct()
    return master.unionByName(fresh.join(welcome, "entity", "left_semi"))


def number_rows(registry: DataFrame, order_by: list[str], name: str = "row_id") -> DataFrame:
    """Registry rows with a running number from 1 in the given order."""
    return number_in_order(registry, [F.col(c) for c in order_by], name, start=1)
