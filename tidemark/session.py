"""Session set-up, the shared scratch folder and two small table helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster, use the session it gives you."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster an unset folder is an error, since a machine-local one would be lost
    with its machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return configured or current


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is written yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """Paths in any store Spark reaches that match a glob pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [one.getPath().toString() for one in found or []]


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder this library wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread_out(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Spread rows over the cores where the input has too few pieces to keep them busy.

    A gzip file or a one-row-group file is a single task however large it is.
    Inputs that already come in at least ``parts`` pieces are left alone, so a big
    table gets no shuffle from this.
    """
    parts = parts or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def spare_names(df: DataFrame, *wanted: str) -> list[str]:
    """Each name, with underscores in front until no column of ``df`` is called so, in any case."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def explode_words(df: DataFrame, keep: list[str], words: Column, pos: str | None = None, name: str = "word") -> DataFrame:
    """One row per element of a computed array; rows with an empty array vanish.

    A plain ``explode`` makes Spark first filter on the array's size, which computes
    a tokenised text twice. The outer form followed by a null test does not.
    """
    if pos is None:
        rows = df.select(*keep, F.explode_outer(words).alias(name))
    else:
        rows = df.select(*keep, F.posexplode_outer(words).alias(pos, name))
    return rows.filter(F.col(name).isNotNull())


@contextlib.contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Within this, what a write shuffled is deleted once it is written.

    Otherwise it stays on the executors' disks until the driver happens to collect its garbage.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Used where a result feeds several branches: it is computed once, survives lost
    executors, and the planner knows its true size when it picks the next joins.
    """
    path = new_folder(df.sparkSession, label)
    with shuffles_let_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_if_small(df: DataFrame, limit: int) -> list | None:
    """Rows of a dimension on the driver, or None when there are more than ``limit``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def number_in_order(df: DataFrame, order_by: list[Column], name: str, start: int = 0) -> DataFrame:
    """Dense numbers in global sort order without sorting everything in one task.

    Rows are range-partitioned and sorted, stored once (range boundaries are
    sampled, so they must not be computed twice), then each partition is shifted
    by the number of rows before it. Only one row per partition reaches the
    running sum.
    """
    low_bits = (1 << 33) - 1
    ranged = store(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_row", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_row", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_row").bitwiseAND(low_bits) + F.lit(start))
        .drop("_part", "_row", "_offset")
    )
