"""What the tables already reflect, and what has to change before a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distributary.functions.schema_uri import (
    GROUP_COLUMNS,
    KEY_COLUMNS,
    format_uri,
    key_struct,
    parse_uri,
    uri_error,
)
from distributary.operators.registry import schemas_until

MATCH, OUTDATED, MISSING = "Match", "Outdated", "Missing"

# Most schema versions (six short fields each) that are sent to all tasks.
BROADCAST_KEYS = 100_000

# Messages about table comments.
MISSING_COMMENT = "Iglu comment is missing in table %s; The table will be ignored"
INVALID_COMMENT = "Comment on table %s (%s) is not valid Iglu URI (%s)"


def table_state(entities: DataFrame, state: DataFrame, atomic_schema: str) -> DataFrame:
    """Add ``table_state`` to rows with the six key columns.

    ``state`` has one row per schema version that a table reflects. The events table always matches. The rows are
    read once and meet the state where they are, if that is small (``BROADCAST_KEYS``, counted without looking at
    the rows), so a popular schema is no hot key; adaptive execution splits it where the state is larger.
    """
    few = state.count() <= BROADCAST_KEYS
    return key_states(entities, state, atomic_schema, few).select(*entities.columns, "table_state")


def key_states(keys: DataFrame, state: DataFrame, atomic_schema: str, few: bool = False) -> DataFrame:
    """``table_state`` of keys; a state of ``few`` rows goes to all tasks."""
    versions = state.select(*KEY_COLUMNS, F.lit(True).alias("version_known")).distinct()
    groups = state.select(*GROUP_COLUMNS, F.lit(True).alias("group_known")).distinct()
    if few:
        versions, groups = F.broadcast(versions), F.broadcast(groups)
    atomic = parse_uri(F.lit(atomic_schema))
    is_atomic = (
        (F.col("vendor") == atomic["vendor"])
        & (F.col("name") == atomic["name"])
        & (F.col("model") == atomic["model"])
    )
    result = (
        F.when(is_atomic, MATCH)
        .when(F.col("group_known").isNull(), MISSING)
        .when(F.col("version_known").isNull(), OUTDATED)
        .otherwise(MATCH)
    )
    return (
        keys.join(groups, GROUP_COLUMNS, "left")
        .join(versions, KEY_COLUMNS, "left")
        .withColumn("table_state", result)
        .drop("group_known", "version_known")
    )


def event_state(checked: DataFrame, event: str) -> DataFrame:
    """Schemas that each event needs created or added before it can be loaded."""
    uri = format_uri(key_struct())

    def needed(state: str):
        return F.sort_array(F.collect_set(F.when(F.col("table_state") == state, uri)))

    return (
        checked.groupBy(event)
        .agg(needed(MISSING).alias("missing"), needed(OUTDATED).alias("outdated"))
        .withColumn("ok", (F.size("missing") == 0) & (F.size("outdated") == 0))
    )


def put(state: DataFrame, schemas: DataFrame) -> DataFrame:
    """State after the tables of ``schemas`` have been brought up to these versions."""
    fresh = schemas.select(*KEY_COLUMNS)
    kept = state.join(fresh.select(*GROUP_COLUMNS).distinct(), GROUP_COLUMNS, "left_anti")
    return kept.select(*KEY_COLUMNS).unionByName(fresh)


def comment_issues(tables: DataFrame, events_table: str = "events") -> DataFrame:
    """Check ``comment`` of every table (``table_name``) but the events table."""
    comment, name = F.col("comment"), F.col("table_name")
    code = F.when(comment.isNotNull(), uri_error(comment))
    missing = F.format_string(MISSING_COMMENT, name)
    invalid = F.format_string(INVALID_COMMENT, name, comment, code)
    issue = F.when(comment.isNull(), "Missing").when(code.isNotNull(), "Invalid")
    return (
        tables.where(name != events_table)
        .withColumn("issue", issue)
        .withColumn("message", F.when(F.col("issue") == "Missing", missing).otherwise(invalid))
        .withColumn("key", F.when(F.col("issue").isNull(), parse_uri(comment)))
    )


def state_from_comments(tables: DataFrame, schemas: DataFrame) -> DataFrame:
    """State after a restart: the versions of each group up to the one its table's comment names."""
    known = comment_issues(tables).where("issue is null").select("key.*")
    return schemas_until(schemas, known).select(*KEY_COLUMNS)
