"""A streaming sink that hands over bad rows in puts of bounded size, for stores that refuse larger ones.

A put has at most ``max_items`` items and ``max_bytes`` bytes; an item that is larger by itself is a put of its own. Each
task writes its puts, in order, as the row groups of one Parquet file with a name of its own; the file is named by the
batch's manifest, which the driver writes when all tasks are done. Files of tasks that failed, were repeated or lost are
in no manifest, and a batch that is written again replaces its manifest: readers (``committed_puts``) see every item
once.

    spark.dataSource.register(BoundedPuts)
    frame.writeStream.format("bounded_puts").options(path=..., max_items=500, max_bytes=5000000)
        .option("checkpointLocation", ...).start()

The frame has one column, ``value``. Null values are not handed over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

MAX_ITEMS, MAX_BYTES = 500, 5_000_000
PUT = pa.schema([("put", pa.int64()), ("value", pa.string())])
PUT_COLUMNS = "put long, value string"


@dataclass
class Written(WriterCommitMessage):
    """The file of a task, and how many items it has."""

    file: str
    items: int


class BoundedPuts(DataSource):
    """The sink ``bounded_puts``."""

    @classmethod
    def name(cls) -> str:
        return "bounded_puts"

    def streamWriter(self, schema: object, overwrite: bool) -> PutWriter:
        options = dict(self.options)
        return PutWriter(options["path"], int(options.get("max_items", MAX_ITEMS)), int(options.get("max_bytes", MAX_BYTES)))


def puts_of(items: Iterator[str], max_items: int, max_bytes: int) -> Iterator[list[str]]:
    """Consecutive items together, as many as fit."""
    held, size = [], 0
    for item in items:
        length = len(item.encode())
        if held and (len(held) == max_items or size + length > max_bytes):
            yield held
            held, size = [], 0
        held.append(item)
        size += length
    if held:
        yield held


class PutWriter(DataSourceStreamArrowWriter):
    """Writes the puts of a task and the manifest of a batch."""

    def __init__(self, path: str, max_items: int, max_bytes: int) -> None:
        self.path, self.max_items, self.max_bytes = path, max_items, max_bytes

    def store(self) -> tuple[pa.fs.FileSystem, str]:
        return pa.fs.FileSystem.from_uri(self.path) if "://" in self.path else (pa.fs.LocalFileSystem(), self.path.removeprefix("file:"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = self.store()
        store.create_dir(f"{path}/puts", recursive=True)
        name, items = f"{uuid.uuid4().hex}.parquet", 0
        values = (v for batch in iterator for v in batch.column(0).cast(pa.string()).to_pylist() if v is not None)
        with store.open_output_stream(f"{path}/puts/{name}") as out, pq.ParquetWriter(out, PUT) as writer:
            for number, put in enumerate(puts_of(values, self.max_items, self.max_bytes)):
                writer.write_table(pa.table([[number] * len(put), put], schema=PUT))
                items += len(put)
        return Written(name, items)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        store, path = self.store()
        store.create_dir(f"{path}/manifests", recursive=True)
        done = [{"file": m.file, "items": m.items} for m in messages if m is not None]
        with store.open_output_stream(f"{path}/manifests/.{batchId}.new") as out:
            out.write("\n".join(json.dumps({"batch": batchId, **m}) for m in done).encode())
        store.move(f"{path}/manifests/.{batchId}.new", f"{path}/manifests/{batchId}.json")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        store, path = self.store()
        for message in messages:
            if message is not None:
                store.delete_file(f"{path}/puts/{message.file}")


def committed_puts(spark: SparkSession, path: str) -> DataFrame:
    """``batch``, ``file``, ``put`` and ``value`` of all items of finished batches."""
    manifests = spark.read.schema("batch long, file string, items long").json(f"{path}/manifests")
    rows = spark.read.schema(PUT_COLUMNS).parquet(f"{path}/puts").select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "put", "value"
    )
    return rows.join(manifests.where("items > 0").select("batch", "file"), "file").select("batch", "file", "put", "value")
