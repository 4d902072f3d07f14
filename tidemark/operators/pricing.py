"""Mean price per group and the bid that follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cheapest_group(
    prices: DataFrame, lead: str, other: str, now: Column, hours: int = 3,
    multiplier: float = 1.2, floor: float = 0.015, digits: int = 3,
) -> DataFrame:
    """``(item, grp, price, bid)`` of two items, both in the group where ``lead`` is cheapest.

    ``prices`` has ``item, grp, ts, price``; means run over the ``hours`` up to
    ``now``. The bid is the rounded mean times ``multiplier``, at least ``floor``.
    An item without prices in the group has no price and bids the floor. Equal
    means go to the lowest group.
    """
    in_time = F.col("ts").between(now - F.expr(f"INTERVAL {int(hours)} HOURS"), now)
    recent = prices.filter(in_time & F.col("item").isin(lead, other))

    def rounded(col: Column) -> Column:
        return F.round(col.cast("decimal(28,10)"), digits).cast("double")

    means = recent.groupBy("grp", "item").agg(rounded(F.avg("price")).alias("price"))
    # one row per group: the leader's and the other's mean
    wide = means.groupBy("grp").agg(
        F.max(F.when(F.col("item") == lead, F.col("price"))).alias("lead_price"),
        F.max(F.when(F.col("item") == other, F.col("price"))).alias("other_price"),
    )
    best = wide.filter(F.col("lead_price").isNotNull()).agg(
        F.min(F.struct("lead_price", "grp", "other_price")).alias("best")
    )
    pair = F.array(
        F.struct(F.lit(lead).alias("item"), F.col("best.grp").alias("grp"), F.col("best.lead_price").alias("price")),
        F.struct(F.lit(other).alias("item"), F.col("best.grp").alias("grp"), F.col("best.other_price").alias("price")),
    )
    bid = F.greatest(F.coalesce(rounded(F.col("price") * multiplier), F.lit(floor)), F.lit(floor))
    return best.filter(F.col("best").isNotNull()).select(F.inline(pair)).withColumn("bid", bid)
