"""From lines to good records and bad rows: one narrow plan where the registry travels with it, else joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.functions.errors import error, no_errors, settled
from distributary.functions.payload import NOT_UTF8, REPLACE, STRICT, base64_line, decode_payload
from distributary.functions.schema_uri import SCHEMA_KEY
from distributary.operators.atomic import choose_errors, shred_atomic
from distributary.operators.badrows import (
    GENERIC_ERROR,
    LOADER_RUNTIME_ERROR,
    PARSING_ERROR,
    SCHEMA_ERROR,
    bad_row_json,
)
from distributary.operators.constraints import atomic_violation, first_violation
from distributary.operators.entities import meta_columns
from distributary.operators.parse import parse
from distributary.operators.shred import NO_SCHEMAS, Registry, shred_entities
from distributary.functions.event_layout import EVENTS_TABLE
from distributary.settings import Settings

BAD_ROWS = "_bad"


def shred(
    lines: DataFrame, registry: Registry, settings: Settings, column: str = "value"
) -> DataFrame:
    """Records of the lines: ``payload``, ``atomic`` (events only), ``entities`` and ``failure``.

    ``failure`` (kind and errors) is NULL for a record that can be loaded whole. A failed entity spoils
    its record, never another one, also where two records carry the same id.
    """
    if settings.decoding == REPLACE:
        lines = lines.withColumn(column, decode_payload(F.col(column)))
    parsed = parse(lines, settings.purpose, column)
    shredded = shred_entities(
        parsed, registry, settings.includes_meta, settings.atomic_schema, settings.date_mode
    )
    entity_errors = F.flatten(F.col("entities")["errors"])
    violation = first_violation(F.col("entities")["violation"])
    if settings.includes_meta:
        shredded = shredded.withColumn("atomic", shred_atomic("atomic", settings.lengths))
        violation = F.coalesce(atomic_violation("atomic"), violation)
        entity_errors = choose_errors(entity_errors, no_errors())
    checked = shredded.withColumns({"entity_errors": entity_errors, "violation": violation})
    failed = checked.withColumn("failure", failure(settings))
    if settings.decoding == STRICT:
        raw = F.col("payload")
        failed = failed.withColumn("payload", F.when(F.is_valid_utf8(raw), raw).otherwise(base64_line(raw.cast("binary"))))
    return settled(failed.drop("errors", "entity_errors", "violation"))


def failure(settings: Settings) -> Column:
    """Failure of a record: parsing before shredding before constraints."""
    if settings.includes_meta:
        kinds = [PARSING_ERROR, SCHEMA_ERROR, LOADER_RUNTIME_ERROR]
        message = F.col("violation")
    else:
        kinds = [GENERIC_ERROR] * 3
        message = F.concat(F.lit("Cannot insert: "), F.col("violation"))
    runtime = F.array(error("RuntimeError", message))

    def entry(kind: str, errors: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), errors.alias("errors"))

    malformed = F.array(error("ParsingError", NOT_UTF8))
    wrong_bytes = F.lit(settings.decoding == STRICT) & ~F.is_valid_utf8("payload")
    return (
        F.when(wrong_bytes, entry(kinds[0], malformed))
        .when(F.size("errors") > 0, entry(kinds[0], F.col("errors")))
        .when(F.size("entity_errors") > 0, entry(kinds[1], F.col("entity_errors")))
        .when(F.col("violation").isNotNull(), entry(kinds[2], runtime))
    )


def good_records(records: DataFrame) -> DataFrame:
    return records.where("failure is null").drop("failure")


def bad_records(records: DataFrame) -> DataFrame:
    """Kind, errors and original line of every record that cannot be loaded."""
    bad = records.where("failure is not null")
    return bad.select("failure.kind", "failure.errors", "payload")


def entity_rows(records: DataFrame) -> DataFrame:
    """One row per entity of the good records."""
    return good_records(records).select(F.inline("entities"))


def event_rows(records: DataFrame) -> DataFrame:
    """Rows of the events table."""
    return good_records(records).select("atomic.*")


def table_rows(records: DataFrame, settings: Settings) -> DataFrame:
    """Every row to write, in one pass: ``table_name`` tells the table, or the bad rows.

    ``unknown`` names the schemas of a bad row whose groups the registry does not have.
    """
    atomic_type = records.schema["atomic"].dataType if settings.includes_meta else None
    no_text, no_list = F.lit(None).cast("string"), F.lit(None).cast("array<string>")

    def row(table: Column, bad: Column, columns: Column, cells: Column, meta: Column, atomic, unknown=no_list) -> Column:
        parts = [
            table.alias("table_name"),
            bad.alias("bad_row"),
            columns.alias("columns"),
            cells.alias("cells"),
            meta.alias("meta"),
            unknown.alias("unknown"),
        ]
        if settings.includes_meta:
            parts.append(atomic.alias("atomic"))
        return F.struct(*parts)

    no_atomic = F.lit(None).cast(atomic_type) if settings.includes_meta else None
    root_id = F.col("atomic.event_id") if settings.includes_meta else no_text
    root_tstamp = (
        F.col("atomic.collector_tstamp")
        if settings.includes_meta
        else F.lit(None).cast("timestamp_ntz")
    )
    null_key = F.lit(None).cast(SCHEMA_KEY)
    no_meta = F.struct(
        *meta_columns(null_key, no_text, F.lit(None).cast("timestamp_ntz")), no_text.alias("schema")
    )
    good = F.transform(
        "entities",
        lambda e: row(
            e["table_name"],
            no_text,
            e["columns"],
            e["cells"],
            F.struct(
                *meta_columns(e["key"], root_id, root_tstamp),
                e["schema"].alias("schema"),
            ),
            no_atomic,
        ),
    )
    if settings.includes_meta:
        event = row(F.lit(EVENTS_TABLE), no_text, no_list, no_list, no_meta, F.col("atomic"))
        good = F.concat(F.array(event), good)
    bad_text = bad_row_json(F.col("failure"), F.col("payload"), settings)
    missing = F.filter("failure.errors", lambda e: e["error"] == NO_SCHEMAS)["schema"]
    bad = F.array(row(F.lit(BAD_ROWS), bad_text, no_list, no_list, no_meta, no_atomic, missing))
    return records.select(F.inline(F.when(F.col("failure").isNull(), good).otherwise(bad)))
