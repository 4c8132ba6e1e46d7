"""Bad rows: what failed, why, and the original payload."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.functions.payload import NOT_UTF8, base64_line

if TYPE_CHECKING:
    from distributary.settings import Settings

# Kinds of bad rows.
PARSING_ERROR = "loader_parsing_error"
SCHEMA_ERROR = "loader_iglu_error"
LOADER_RUNTIME_ERROR = "loader_runtime_error"
GENERIC_ERROR = "generic_error"


def bad_row_json(failure: Column, payload: Column, settings: Settings) -> Column:
    """One compact JSON document; a generic error also tells when it happened."""
    processor = F.struct(
        F.lit(settings.processor_name).alias("artifact"),
        F.lit(settings.processor_version).alias("version"),
    )
    now = F.when(failure["kind"] == GENERIC_ERROR, F.current_timestamp())
    return F.to_json(
        F.struct(
            failure["kind"].alias("kind"),
            processor.alias("processor"),
            F.struct(now.alias("timestamp"), failure["errors"].alias("errors")).alias("failure"),
            payload.alias("payload"),
        )
    )


def undecodable(records: DataFrame, column: str, purpose_is_enriched: bool) -> DataFrame:
    """Bad rows of byte records that are not UTF-8; the payload is the base64 of the bytes."""
    kind = PARSING_ERROR if purpose_is_enriched else GENERIC_ERROR
    text = F.col(column).cast("string")
    return records.where(~F.is_valid_utf8(text)).select(
        F.lit(kind).alias("kind"),
        F.lit(NOT_UTF8).alias("message"),
        base64_line(F.col(column)).alias("payload"),
    )


def period_start(time: Column, seconds: int) -> Column:
    """Start of the period of a time; ``window`` would drop rows without one, this gives them NULL."""
    at = F.unix_seconds(time.cast("timestamp"))
    return F.timestamp_seconds(at - F.pmod(at, F.lit(seconds))).cast("timestamp_ntz")


def discard_counts(bad: DataFrame, time_column: str, period_seconds: int = 30) -> DataFrame:
    """Bad rows per period; periods without any do not appear. Rows without a time are one period of their own."""
    return (
        bad.groupBy(period_start(F.col(time_column), period_seconds).alias("period_start"))
        .agg(F.count("*").alias("discarded"))
        .select("period_start", "discarded")
    )
