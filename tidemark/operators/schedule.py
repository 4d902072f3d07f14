"""Event schedule: reading it from HTML and finding the event nearest to an instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import explode_words

# The page's markup, the start assumed where none is given, and the note on it.
ITEM = r'(?s)class="debate-schedule-item".*?(?=class="debate-schedule-item"|\z)'
PARTY = r'class="party"[^>]*>([^<]*)<'
DATE = r'class="date"[^>]*>([^<]*)<'
TIME = r'(?s)<span[^>]*class="label"[^>]*>[^<]*Time[^<]*</span>([^<]*)'
CLOCK = r"(\d{1,2}):?(\d{2})?\sp\.m\."
DEFAULT_TIME = "20:00"
DAY = 86_400
CAVEAT = (
    "The time for this debate has not yet been officially set. "
    "The time given here is an approximation based on previous debate schedules."
)


def schedule_from_html(pages: DataFrame, html: str = "html") -> DataFrame:
    """``(party, date, time, datetime, caveat)`` of every schedule item with a readable date.

    Times are afternoon times: ``8:30 p.m.`` and ``9 p.m.`` become 20:30 and 21:00.
    An item without a readable time gets the default start and a caveat.
    """
    keys = [c for c in pages.columns if c != html]
    items = explode_words(pages, keys, F.regexp_extract_all(html, F.lit(ITEM), F.lit(0)), name="item")
    parts = items.select(
        *keys,
        F.substring_index(F.regexp_extract("item", PARTY, 1), " ", 1).alias("party"),
        F.regexp_replace(F.regexp_extract("item", DATE, 1), "[.,]", "").alias("date"),
        F.regexp_extract("item", TIME, 1).alias("label"),
    )
    words = F.split("date", " ")
    day = F.try_to_timestamp(
        F.concat_ws(" ", F.initcap(F.substring(F.get(words, F.lit(0)), 1, 3)), F.get(words, F.lit(1)), F.get(words, F.lit(2))),
        F.lit("MMM d yyyy"),
    )
    hour = F.regexp_extract("label", CLOCK, 1).try_cast("int")
    minute = F.regexp_extract("label", CLOCK, 2)
    clock = F.when(
        hour.between(1, 12),
        F.format_string("%02d:%s", F.pmod(hour, F.lit(12)) + 12, F.when(minute == "", "00").otherwise(minute)),
    )
    return (
        parts.withColumn("clock", clock)
        .withColumn("day", F.date_format(day, "yyyy-MM-dd"))
        .filter((F.size(words) == 3) & F.col("day").isNotNull())
        .withColumn("time", F.coalesce("clock", F.lit(DEFAULT_TIME)))
        .select(
            *keys, "party", "date", "time",
            F.concat("day", F.lit("T"), "time", F.lit(":00")).alias("datetime"),
            F.when(F.col("clock").isNull(), F.lit(CAVEAT)).otherwise("").alias("caveat"),
        )
    )


def fitting_bucket(schedule: DataFrame, widest: int = 86_400, crowd: int = 8) -> int:
    """The widest bucket (seconds) that holds at most ``crowd`` different starts anywhere.

    One second always does. Only one number per candidate width reaches the driver.
    """
    widths = sorted({max(1, widest // 4**i) for i in range(12)})
    most = (
        schedule.select("start").distinct()
        .select(F.explode(F.array(*[F.lit(w) for w in widths])).alias("width"), "start")
        .groupBy("width", F.floor(F.col("start") / F.col("width")).alias("bucket")).count()
        .groupBy("width").agg(F.max("count").alias("most"))
        .filter(F.col("most") <= crowd)
        .agg(F.max("width").alias("width"))
        .first()
    )
    return most.width or 1


def _with_neighbours(rows: DataFrame, order: str, within: WindowSpec) -> DataFrame:
    """Add ``prev``, the last event before a row, and ``next``, the first one after it.

    Both look back over rows that have been seen, once in either order; a frame that
    reaches to the end would be worked out anew for every row.
    """
    seen = (Window.unboundedPreceding, -1)
    return rows.select(
        "*",
        F.last("last", ignorenulls=True).over(within.orderBy(order).rowsBetween(*seen)).alias("prev"),
        F.last("first", ignorenulls=True).over(within.orderBy(F.desc(order)).rowsBetween(*seen)).alias("next"),
    )


def nearest_event(
    points: DataFrame, schedule: DataFrame, grace: int = 3 * 3600, bucket: int | None = None
) -> DataFrame:
    """The next event of every instant, or one that began at most ``grace`` seconds ago, whichever is closer.

    ``points`` has ``epoch``; ``schedule`` has ``ordinal`` and ``start`` (epoch
    seconds). Adds ``ordinal``, ``start`` and ``delta`` (start minus instant), null
    when nothing qualifies; a tie goes to the lower ordinal.

    Two neighbouring events bound a stretch of time, and every instant lies in one
    stretch. Stretches are cut at bucket borders and matched to the instants on the
    bucket, an equi-join that Spark may broadcast or shuffle. Unless given, the
    bucket is chosen so that no instant is compared with more than a few stretches.
    Neighbours are found inside each bucket, then among the buckets of a day, then
    among days; only one row per day takes part in the step that looks across all.
    """
    bucket = bucket or fitting_bucket(schedule)
    events = schedule.groupBy("start").agg(F.min("ordinal").alias("ordinal"))
    point_bucket = F.floor(F.col("epoch") / bucket)

    in_bucket = Window.partitionBy("bucket").orderBy("start")
    here = events.withColumn("bucket", F.floor(F.col("start") / bucket)).withColumn(
        "event", F.struct("start", "ordinal")
    )
    edges = here.groupBy("bucket").agg(F.min("event").alias("first"), F.max("event").alias("last"))
    axis = (
        points.select(point_bucket.alias("bucket")).distinct()
        .unionByName(edges.select("bucket")).distinct()
        .join(edges, "bucket", "left")
    )
    axis = axis.withColumn("day", F.floor(F.col("bucket") * bucket / DAY))
    days = axis.groupBy("day").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    days = _with_neighbours(days, "day", Window.partitionBy()).select(
        "day", F.col("prev").alias("day_before"), F.col("next").alias("day_after")
    )
    axis = _with_neighbours(axis, "bucket", Window.partitionBy("day")).join(days, "day").select(
        "bucket", "first", "last",
        F.coalesce("prev", "day_before").alias("prev"), F.coalesce("next", "day_after").alias("next"),
    )
    # the stretch before the first event of a bucket (all of it when there is none) ...
    opening = axis.select(
        "bucket", F.lit(None).cast("long").alias("from_epoch"), F.col("prev").alias("before"),
        F.coalesce("first", "next").alias("after"),
    )
    # ... and the stretch that starts with each of its events
    following = (
        here.withColumn("after", F.lead("event").over(in_bucket))
        .join(axis.select("bucket", "next"), "bucket")
        .select(
            "bucket", F.col("start").alias("from_epoch"), F.col("event").alias("before"),
            F.coalesce("after", "next").alias("after"),
        )
    )
    stretches = opening.unionByName(following).select(
        "bucket", "from_epoch", "before", "after",
        F.when(F.floor(F.col("after.start") / bucket) == F.col("bucket"), F.col("after.start")).alias("to_epoch"),
    )
    found = points.withColumn("bucket", point_bucket).join(stretches, "bucket").filter(
        (F.col("from_epoch").isNull() | (F.col("epoch") >= F.col("from_epoch")))
        & (F.col("to_epoch").isNull() | (F.col("epoch") < F.col("to_epoch")))
    )

    def choice(event: str, eligible: Column) -> Column:
        delta = F.col(f"{event}.start") - F.col("epoch")
        return F.when(
            eligible,
            F.struct(
                F.abs(delta).alias("distance"), F.col(f"{event}.ordinal").alias("ordinal"),
                F.col(f"{event}.start").alias("start"), delta.alias("delta"),
            ),
        )

    before = choice("before", F.col("before").isNotNull() & (F.col("epoch") - F.col("before.start") <= grace))
    after = choice("after", F.col("after").isNotNull())
    return found.withColumn("best", F.least(before, after)).select(
        *points.columns, "best.ordinal", "best.start", "best.delta"
    )
