"""Token ids as Parquet lists, written in document order and read back selectively."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices
from tidemark.llm.encoders import encoder

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
DICTIONARY_BYTES = 1 << 20
FILE = "part int, doc_id long, start_in_part long, n_tokens long, ids array<int>"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode whole texts, append ``end_id`` to each, and write them in ascending order of id.

    Rows are dealt out by ranges of the id, so file ``part`` holds ids below those of
    ``part + 1`` and a task holds one slice of a range at a time. Token lists are
    dictionary-encoded, the numbers beside them delta-encoded; row groups and pages have
    the given sizes, and the writer adds page indexes, so that a filter on ``doc_id`` or a
    choice of columns reads little else. Null texts count as empty, null ids come first,
    repeated rows are all written, other columns are left out, and an empty table writes
    no tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, done = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text"):
            data = [encode(whole) + end for whole in batch.column("text").to_pylist()]
            sizes = np.array([len(ids) // 4 for ids in data], dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.frombuffer(b"".join(data), dtype="<u4").astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(sizes), part, np.int32)),
                    "doc_id": batch.column("doc_id"),
                    "start_in_part": pa.array(done + ends[:-1]),
                    "n_tokens": pa.array(sizes),
                    "ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                }
            )
            done += int(ends[-1])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    writer = ordered.mapInArrow(run, FILE).write.mode("errorifexists")
    for name, value in {
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.dictionary.page.size": DICTIONARY_BYTES,
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#start_in_part": "false",
    }.items():
        writer = writer.option(name, str(value))
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; selecting columns or filtering ids reads only what that needs."""
    return spark.read.schema(FILE).parquet(path)


def read_starts(spark: SparkSession, path: str) -> DataFrame:
    """Tokens before each part: one row per part, from the count columns alone."""
    sums = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``, taken from the ids read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            at = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
            raw = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)).astype("<i4", copy=False)
            raw = memoryview(raw).cast("B") if len(raw) else memoryview(b"")
            sums = [zlib.crc32(raw[4 * low : 4 * high]) for low, high in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": batch.column("part"),
                    "doc_id": batch.column("doc_id"),
                    "start_in_part": batch.column("start_in_part"),
                    "n_tokens": pa.array(np.diff(at).astype(np.int64)),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )

    schema = "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"
    rows = read_tokens(spark, path).select("part", "doc_id", "start_in_part", "ids").mapInArrow(run, schema)
    started = rows.join(read_starts(spark, path), "part")
    return started.select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32", "part"
    )
