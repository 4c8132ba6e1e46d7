"""Batches that become visible whole: a manifest of committed batches beside the tables they fill.

Every attempt to load a batch has a token of its own. Rows carry it in ``BATCH_COLUMN``, by which tables are
partitioned, and the batch is committed by one row in the manifest, written after all its tables. Readers see the rows
of committed tokens only, so a batch is in all its tables or in none, and an attempt that stopped half way, or that was
overtaken by another attempt at the same batch, leaves nothing that anybody sees. What it left is only removed by
``drop_abandoned``, when no load is running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distributary.settings import BATCH_COLUMN

MANIFEST = "committed_batches"
MANIFEST_COLUMNS = "token string, stream string, number long"
BROADCAST_TOKENS = 100_000


def create_manifest(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{MANIFEST}` ({MANIFEST_COLUMNS}) USING parquet")


def commit(spark: SparkSession, database: str, token: str, stream: str, number: int) -> None:
    """Make a batch visible; a file is there whole or not at all."""
    row = spark.createDataFrame([(token, stream, number)], MANIFEST_COLUMNS)
    row.coalesce(1).write.insertInto(f"{database}.{MANIFEST}")


def committed_tokens(spark: SparkSession, database: str) -> DataFrame:
    """One token for each batch, also where two attempts at it were committed at a time."""
    rows = spark.table(f"{database}.{MANIFEST}")
    return rows.groupBy("stream", "number").agg(F.min("token").alias(BATCH_COLUMN)).select(BATCH_COLUMN)


def last_committed(spark: SparkSession, database: str, stream: str) -> int:
    """Number of the last committed batch of a stream, -1 if there is none."""
    own = spark.table(f"{database}.{MANIFEST}").where(F.col("stream") == stream)
    return own.agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0]


def committed(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Rows of the committed batches of a table; partitions of other tokens are not read."""
    tokens = committed_tokens(spark, database)
    few = spark.table(f"{database}.{MANIFEST}").count() <= BROADCAST_TOKENS
    rows = spark.table(f"{database}.{table}")
    return rows.join(F.broadcast(tokens) if few else tokens, BATCH_COLUMN, "left_semi").drop(BATCH_COLUMN)


def drop_abandoned(spark: SparkSession, database: str, table: str) -> int:
    """Delete the partitions of attempts that were never committed; no load may run meanwhile. Says how many."""
    known = {r[0] for r in committed_tokens(spark, database).collect()}
    present = spark.table(f"{database}.{table}").select(BATCH_COLUMN).distinct().collect()
    stale = [r[0] for r in present if r[0] not in known]
    for token in stale:
        spark.sql(f"ALTER TABLE `{database}`.`{table}` DROP IF EXISTS PARTITION ({BATCH_COLUMN} = '{token}')")
    return len(stale)
