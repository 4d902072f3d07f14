"""Items that tasks write and the driver commits."""

from __future__ import annotations

import subprocess
import sys

import pyarrow as pa
import pytest
from conftest import ROOT
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.session import new_folder
from tidemark.sources import items


def batches(low, high, fail=False):
    for at in range(low, high, 5):
        yield pa.RecordBatch.from_pydict({"id": list(range(at, min(at + 5, high)))})
    if fail:
        raise RuntimeError("lost")


def ids(path):
    return sorted(pa.parquet.read_table(path)["id"].to_pylist()) if path.exists() else []


def test_a_task_that_fails_once_doubles_nothing(tmp_path):
    writer = items.ItemWriter(str(tmp_path), 3)
    first = writer.write(batches(0, 10))
    with pytest.raises(RuntimeError):
        writer.write(batches(10, 20, fail=True))
    again, empty = writer.write(batches(10, 20)), writer.write(batches(0, 0))
    assert not (tmp_path / "batch_id=3").exists()
    writer.commit([first, again, empty, None])
    assert ids(tmp_path / "batch_id=3") == list(range(20))
    other = items.ItemWriter(str(tmp_path), 3)
    other.commit([other.write(batches(40, 47)), None])
    assert ids(tmp_path / "batch_id=3") == list(range(40, 47))


def test_an_aborted_write_leaves_what_was_there(tmp_path):
    writer = items.ItemWriter(str(tmp_path), 0)
    writer.commit([writer.write(batches(0, 3))])
    failed = items.ItemWriter(str(tmp_path), 0)
    failed.abort([failed.write(batches(5, 9)), None])
    assert ids(tmp_path / "batch_id=0") == [0, 1, 2]
    assert [p.name for p in tmp_path.iterdir()] == ["batch_id=0"]


def test_batches_of_a_table(spark):
    path = new_folder(spark, "items")
    df = spark.range(20).select("id", F.array(F.col("id").cast("string")).alias("tags"))
    items.sink_items(df.filter("id < 10").repartition(4), path, 0)
    items.sink_items(df.filter("id >= 10"), path, 1)
    items.sink_items(df.filter("id >= 15"), path, 1)
    got = items.read_items(spark, path, df.schema)
    assert got.columns == df.columns
    assert sorted(r.id for r in got.collect()) == [*range(10), *range(15, 20)]


def test_a_write_that_fails_is_not_seen(spark):
    path = new_folder(spark, "items")
    items.sink_items(spark.range(5), path, 0)
    broken = spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") == 42, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        items.sink_items(broken, path, 0)
    assert items.read_items(spark, path, "id LONG").count() == 5


RETRIED = """
import os, sys
sys.path.insert(0, sys.argv[1])
import pyarrow as pa
from pyspark import TaskContext
from tidemark.session import local_session
from tidemark.sources import items

spark = local_session("2,3", "retried")
spark.sparkContext.setLogLevel("OFF")

def once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

rows = spark.range(0, 4000, 1, 3).mapInArrow(once, "id long")
items.sink_items(rows, sys.argv[2], 0)
found = sorted(r.id for r in items.read_items(spark, sys.argv[2], "id long").collect())
print("same" if found == list(range(4000)) else found[:10])
spark.stop()
"""


def test_a_retried_task_of_a_job_doubles_nothing(tmp_path):
    """A session of its own, whose tasks may be tried again."""
    done = subprocess.run([sys.executable, "-c", RETRIED, ROOT, str(tmp_path / "items")], capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("same"), done.stderr[-2000:]


def test_sink_posts_joins_the_texts_once(spark, sf_dir, monkeypatch):
    """Each of the three writes used to join all texts and events again."""
    from tidemark.plans import files

    plans = []
    monkeypatch.setattr(files.items, "sink_items", lambda df, path, batch: plans.append(df._jdf.queryExecution().optimizedPlan().toString()))
    monkeypatch.setattr(files.items, "read_items", lambda spark, path, schema: spark.createDataFrame([], schema))
    files.sink_posts(spark, sf_dir)
    assert len(plans) == 3 and not any("Join" in plan for plan in plans)
