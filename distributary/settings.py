"""What a load needs to know, and the session settings it relies on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from distributary.functions.payload import REPLACE, STRICT
from distributary.operators.parse import ENRICHED, SELF_DESCRIBING

NAME = "distributary"
VERSION = "0.1.0"

# Bytes of a method that HotSpot still compiles.
COMPILED_METHOD = 8000

# Column of every table that names the attempt a row was loaded by; tables are partitioned by it.
BATCH_COLUMN = "_load_batch"


@dataclass(frozen=True)
class Settings:
    """Settings of a load.

    ``atomic_schema`` is the schema URI under which the tracker describes the event itself; entities with
    that URI belong to the events table. ``date_mode="reject"`` refuses every value of a DATE column.
    ``decoding="strict"`` refuses records that are not UTF-8 instead of replacing their bytes. ``lengths`` tells
    by column how many characters of a text of the event itself are kept, where it is not the common limit.
    """

    atomic_schema: str
    purpose: str = ENRICHED
    date_mode: str = "parse"
    decoding: str = REPLACE
    lengths: Mapping[str, int] = field(default_factory=dict)
    processor_name: str = NAME
    processor_version: str = VERSION

    def __post_init__(self) -> None:
        if self.purpose not in (ENRICHED, SELF_DESCRIBING):
            raise ValueError(f"purpose must be {ENRICHED} or {SELF_DESCRIBING}")
        if self.date_mode not in ("parse", "reject"):
            raise ValueError("date_mode must be parse or reject")
        if self.decoding not in (REPLACE, STRICT):
            raise ValueError(f"decoding must be {REPLACE} or {STRICT}")

    @property
    def includes_meta(self) -> bool:
        """Entities of events carry their origin; self-describing payloads stand alone."""
        return self.purpose == ENRICHED


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings: the last of two equal JSON keys wins instead of spoiling the document.

    Projections whose generated method would be too large for the JVM to compile are split instead: 131 fields in one
    method run an order of magnitude slower.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_METHOD))
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediate data: the cluster's ``spark.checkpoint.dir``; where that is unset, as in tests, the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{(shared or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{NAME}"
