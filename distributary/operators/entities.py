"""Entities of parsed records as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.functions.event_layout import EVENTS_TABLE
from distributary.functions.schema_uri import format_version, parse_uri


def explode_entities(parsed: DataFrame, *parent: str) -> DataFrame:
    """One row per entity in load order, copies kept; ``parent`` columns are carried along."""
    exploded = parsed.select(*parent, F.posexplode("entities").alias("position", "entity"))
    key = parse_uri(F.col("entity.schema")).alias("key")
    return exploded.select(*parent, "position", "entity.schema", key, "entity.data")


def meta_columns(key: Column, root_id: Column, root_tstamp: Column) -> list[Column]:
    """Origin of an entity: its schema and the event it came with."""
    return [
        key["vendor"].alias("schema_vendor"),
        key["name"].alias("schema_name"),
        key["format"].alias("schema_format"),
        format_version(key).alias("schema_version"),
        root_id.alias("root_id"),
        root_tstamp.alias("root_tstamp"),
    ]


def add_metadata(entities: DataFrame) -> DataFrame:
    """Put the meta columns before the entity; expects ``key``, ``event_id``, ``collector_tstamp``."""
    meta = meta_columns(F.col("key"), F.col("event_id"), F.col("collector_tstamp"))
    return entities.select(*meta, "position", "schema", "data")


def route(schema: Column, atomic_schema: str, entity_table: Column) -> Column:
    """Table of an entity; the schema of the event itself goes to the table of events."""
    return F.when(schema == atomic_schema, EVENTS_TABLE).otherwise(entity_table)
