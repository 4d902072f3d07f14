"""Batch writers. Each one lets the executors write; nothing goes through the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import ascii_only

DAY = 86_400


def sink_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One batch of a table; writing the same batch again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def sink_posts(
    df: DataFrame, path: str, batch_id: int = 0, per_partition: Callable[[Iterable], None] | None = None
) -> None:
    """Tagged posts of a batch as parquet, or handed partition-wise to a store writer."""
    if per_partition is None:
        sink_batch(df, path, batch_id)
    else:
        df.foreachPartition(per_partition)


def sink_summary(items: DataFrame, path: str, batch_id: int = 0) -> None:
    """Summary items of a batch; a retried batch replaces its own items."""
    sink_batch(items, path, batch_id)


def sink_results(results: DataFrame, path: str) -> None:
    """Result rows in one folder per UTC day of their ``timestamp``, which range reads prune by."""
    day = F.floor(F.col("timestamp") / DAY).cast("int")
    results.withColumn("day", day).write.mode("overwrite").partitionBy("day").parquet(path)


def sink_gzip_text(df: DataFrame, path: str) -> None:
    """Records as gzipped JSON lines."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def sink_hourly_json(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Reduced posts as JSON lines in one folder per hour, the id inside the record.

    The hour folder is the only partitioning, so a busy hour is written by as
    many tasks as hold its rows.
    """
    (
        df.withColumn("hour", F.replace(F.substring(F.col(ts), 1, 13), F.lit(" "), F.lit("-")))
        .withColumnRenamed("id", "tweet_id")
        .write.mode("overwrite")
        .partitionBy("hour")
        .json(path)
    )


def sink_quoted_csv(df: DataFrame, path: str) -> None:
    """All-quoted CSV with a header line."""
    df.write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"', emptyValue="")


def sink_loglik(df: DataFrame, path: str, step: int) -> None:
    """Log-likelihood rows ``(part, phase, loglik)`` of one iteration; writing it again replaces them."""
    df.write.mode("overwrite").parquet(f"{path}/iter={step}")


def eav_melt(df: DataFrame, id_col: str, keep_raw: tuple[str, ...] = ("batchtime",)) -> DataFrame:
    """Records as ``(id, name, value)`` attribute rows, all values text.

    Arrays become comma-joined text, booleans ``True``/``False``, missing values
    empty text. Non-ASCII characters are dropped except in the ``keep_raw`` columns.
    """
    types = dict(df.dtypes)
    attributes = []
    for name in df.columns:
        if name == id_col:
            continue
        col = F.col(name)
        if types[name].startswith("array"):
            value = F.array_join(col, ",")
        elif types[name] == "boolean":
            value = F.initcap(col.cast("string"))
        else:
            value = col.cast("string")
        value = F.coalesce(value, F.lit(""))
        attributes.append((value if name in keep_raw else ascii_only(value)).alias(name))
    wide = df.select(F.col(id_col).cast("string").alias(id_col), *attributes)
    return wide.unpivot([id_col], None, "name", "value")
