"""Intermediate tables in the folder that driver and executors share, and broadcasts of checked size."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BROADCAST_BYTES = 32 << 20
ARROW_BYTES = 4 << 20
# Folders written within each open block of ``spent_tables``.
SPENT: ContextVar[tuple[list[str], ...]] = ContextVar("spent", default=())


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset, as in tests, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/shared").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """Writes the frame to the shared folder and reads it back: its lineage ends there."""
    folder = new_folder(frame.sparkSession, name)
    for folders in SPENT.get():
        folders.append(folder)
    frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def deleted(spark: SparkSession, folder: str) -> None:
    """Deletes a table of ``written`` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def spent_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Gives the folders that ``written`` makes in the block, the latest last, and deletes them at its end.

    What the block returns must be written in it, last, and its folder be taken out of the list.
    """
    folders: list[str] = []
    token = SPENT.set((*SPENT.get(), folders))
    try:
        yield folders
    finally:
        SPENT.reset(token)
        for folder in folders:
            deleted(spark, folder)


ARROW_TYPES = {
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a flat DDL string; tasks may call it, as it needs no session."""
    fields = [field.split() for field in ddl.split(",")]
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in fields])


def found_by_tasks(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, whatever their working folder is."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def small_batches(spark: SparkSession) -> None:
    """Bounds the bytes of the batches that Spark and Python exchange, which hold whole texts, unless the session does."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the start of every query."""
    found_by_tasks(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
