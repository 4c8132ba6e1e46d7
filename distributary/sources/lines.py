"""Line and record sources, batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from distributary.functions.payload import REPLACE, STRICT, decode_payload

TRIM_HORIZON, LATEST, AT_TIMESTAMP = "TRIM_HORIZON", "LATEST", "AT_TIMESTAMP"


def not_empty(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.where(F.length(column) > 0)


def decoded(lines: DataFrame, decoding: str) -> DataFrame:
    """Non-empty lines; ``strict`` leaves malformed bytes in place for the load to refuse them."""
    if decoding == STRICT:
        return not_empty(lines)
    return not_empty(lines.withColumn("value", decode_payload(F.col("value"))))


def read_lines(spark: SparkSession, path: str, decoding: str = REPLACE) -> DataFrame:
    """Non-empty lines of a file or of all files below a directory."""
    return decoded(spark.read.option("recursiveFileLookup", True).text(path), decoding)


def stream_lines(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    decoding: str = REPLACE,
) -> DataFrame:
    """The same lines as files arrive; the cap bounds one micro-batch."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decoded(reader.text(path), decoding)


def start_from(
    records: DataFrame, time_column: str, position: str, timestamp: Column | str | None = None
) -> DataFrame:
    """Records from a start position on: all, those after now, or those from a time on."""
    if position == TRIM_HORIZON:
        return records
    if position == LATEST:
        return records.where(F.col(time_column) > F.localtimestamp())
    if position == AT_TIMESTAMP:
        if timestamp is None:
            raise ValueError("AT_TIMESTAMP needs a timestamp")
        limit = F.lit(timestamp).cast("timestamp_ntz") if isinstance(timestamp, str) else timestamp
        return records.where(F.col(time_column) >= limit)
    raise ValueError(f"unknown start position {position!r}")


def broker_options(
    position: str, timestamp_ms: int | None = None, max_records: int | None = None
) -> dict[str, str]:
    """Options of Spark's Kafka source for a start position and a cap of records per micro-batch."""
    if position == AT_TIMESTAMP:
        if timestamp_ms is None:
            raise ValueError("AT_TIMESTAMP needs a timestamp")
        options = {"startingTimestamp": str(timestamp_ms)}
    elif position in (TRIM_HORIZON, LATEST):
        options = {"startingOffsets": "earliest" if position == TRIM_HORIZON else "latest"}
    else:
        raise ValueError(f"unknown start position {position!r}")
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def stream_records(
    spark: SparkSession,
    servers: str,
    topic: str,
    position: str = TRIM_HORIZON,
    timestamp_ms: int | None = None,
    max_records: int | None = None,
) -> DataFrame:
    """Payloads of a topic; needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    for name, value in broker_options(position, timestamp_ms, max_records).items():
        reader = reader.option(name, value)
    records = reader.option("subscribe", topic).load()
    return records.select(decode_payload(F.col("value")).alias("value"))
