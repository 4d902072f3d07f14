"""A table of items that tasks write themselves and the driver commits, as a Spark data source.

Every task writes a file of its own under a staged name. Only when all tasks are done does
the driver take those that reported into the batch's folder, where readers look; what a
lost or repeated attempt left behind never becomes visible. Committing a batch again
replaces its items.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# the writer travels to the workers with its code, so they need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tidemark_items"


@dataclass
class Written(WriterCommitMessage):
    """The staged file of one task; none where the task had no rows."""

    part: int
    file: str | None
    rows: int


class ItemWriter(DataSourceArrowWriter):
    """Tasks stage files beside the batch's folder, in one that readers skip."""

    def __init__(self, path: str, batch_id: int):
        self.path, self.batch_id = path, batch_id
        self.staged = f"_staged-{batch_id}-{uuid.uuid4().hex}"

    def _store(self) -> fs.FileSystem:
        """The store that holds ``path``: a shared folder, or any that Arrow can reach by its address."""
        root, inside = fs.FileSystem.from_uri(self.path if ":" in self.path else f"file://{self.path}")
        return fs.SubTreeFileSystem(inside, root)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        store, name, rows, out = self._store(), f"{self.staged}/{part}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if out is None:
                    store.create_dir(self.staged, recursive=True)
                    out = pq.ParquetWriter(store.open_output_stream(name), batch.schema)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(part, name if out else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        """Put the files of the tasks that count into the batch's folder, in place of what was there."""
        store, folder = self._store(), f"batch_id={self.batch_id}"
        old = f"_replaced-{uuid.uuid4().hex}"
        store.create_dir(self.staged, recursive=True)
        kept = {m.file for m in messages if m and m.file}
        for found in store.get_file_info(fs.FileSelector(self.staged)):
            if f"{self.staged}/{found.base_name}" not in kept:
                store.delete_file(found.path)
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.move(folder, old)
        store.move(self.staged, folder)
        if store.get_file_info(old).type != fs.FileType.NotFound:
            store.delete_dir(old)

    def abort(self, messages: list[Written | None]) -> None:
        store = self._store()
        if store.get_file_info(self.staged).type != fs.FileType.NotFound:
            store.delete_dir(self.staged)


class ItemSource(DataSource):
    """``df.write.format("tidemark_items").mode("append").option("batch", n).save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> ItemWriter:
        return ItemWriter(self.options["path"], int(self.options.get("batch", "0")))


def sink_items(df: DataFrame, path: str, batch_id: int = 0) -> None:
    """The rows of a batch as items under ``path``; the same batch again replaces them."""
    df.sparkSession.dataSource.register(ItemSource)
    df.write.format(FORMAT).mode("append").option("batch", str(batch_id)).save(path)


def read_items(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All committed items, as the table they were written from."""
    kept = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(kept).parquet(path).select(kept.fieldNames())
