"""Lines to parsed records: enriched tab-separated events and self-describing JSON.

Both parsers give the same columns: ``payload`` (the line), ``entities`` (array of schema URI and data, in
load order), ``errors`` (empty for a good record) and, for events, ``atomic`` (the scalar fields).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.functions.casts import UUID_PATTERN
from distributary.functions.errors import error, no_errors, settled
from distributary.functions.event_layout import ATOMIC_FIELDS, JSON_FIELDS, LINE_FIELDS, Field
from distributary.functions.json_values import boxed_document, get_path, json_text, marked, parse_document, written_field
from distributary.functions.schema_uri import (
    INVALID_URI,
    is_uri,
    uri_error,
)

ENRICHED = "ENRICHED_EVENTS"
SELF_DESCRIBING = "JSON"

VALUE = "struct<schema:string,data:variant>"
# ``written`` is the JSON of the data as it stands in the document (see ``json_values.marked``).
ENTITY = "struct<schema:string,data:variant,written:string>"
CLOCK_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?$"
# Fixed value: order in which the three JSON fields of an event give their entities.
ENTITY_ORDER = ["contexts", "derived_contexts", "unstruct_event"]


def parse(lines: DataFrame, purpose: str, column: str = "value") -> DataFrame:
    """Parse lines by the purpose of the load."""
    if purpose == ENRICHED:
        return parse_enriched(lines, column)
    if purpose == SELF_DESCRIBING:
        return parse_self_describing(lines, column)
    raise ValueError(f"purpose must be {ENRICHED} or {SELF_DESCRIBING}, not {purpose!r}")


def field_value(index: int, field: Field) -> str:
    """SQL of the typed value of one field; NULL where it is empty or malformed.

    The 131 fields are written as SQL text: one parse instead of thousands of calls into the JVM.
    """
    raw = raw_field(index)
    if field.kind == "INTEGER":
        return f"if({raw} rlike '^[+-]?[0-9]+$', try_cast({raw} as int), null)"
    if field.kind == "DOUBLE":
        return f"try_cast({raw} as double)"
    if field.kind == "BOOLEAN":
        return f"case {raw} when '1' then true when '0' then false end"
    if field.kind == "TIMESTAMP":
        return f"if({raw} rlike '{CLOCK_PATTERN}', try_cast({raw} as timestamp_ntz), null)"
    if field.kind == "UUID":
        return f"if({raw} rlike '{UUID_PATTERN}', lower({raw}), null)"
    return raw


def raw_field(index: int) -> str:
    return f"get(fields, {index})"


def entity_list(box: Column, text: Column, name: str) -> Column:
    """Entities inside one JSON field (its text, and that as a boxed document), NULL where its envelope is malformed.

    Without values there are no entities either, so the values are not asked for a second time to know that.
    """
    one = name == "unstruct_event"
    source = F.from_json(marked(text), f"data {'' if one else 'array<'}struct<data:string>{'' if one else '>'}")["data"]
    value = F.try_variant_get(box, "$[0].data", VALUE if one else f"array<{VALUE}>")
    values, sources = (F.array(value), F.array(source)) if one else (value, source)
    entities = F.zip_with(
        values,
        F.coalesce(sources, F.array().cast("array<struct<data:string>>")),
        lambda v, w: F.struct(v["schema"].alias("schema"), v["data"].alias("data"), w["data"].alias("written")),
    )
    return F.when(is_uri(F.try_variant_get(box, "$[0].schema", "string")), entities)


def well_formed(entities: Column) -> Column:
    """True where every entity names a schema and has data."""
    return F.forall(entities, lambda e: is_uri(e["schema"]) & e["data"].isNotNull())


def field_checks() -> list[tuple[str, str, str, str]]:
    """SQL condition, message, field name and SQL value of everything that can be wrong with a field."""
    checks = []
    for index, field in enumerate(LINE_FIELDS):
        raw, name = raw_field(index), field.name
        if field.kind not in ("VARCHAR", "CHAR"):
            parsed = f"well_formed_{name}" if field.kind == "JSON" else f"atomic.{name}"
            message = f"Cannot parse {name} as {field.kind}"
            checks.append((f"{raw} is not null and {parsed} is null", message, name, raw))
        if not field.nullable:
            checks.append((f"{raw} is null", f"Field {name} cannot be empty", name, "''"))
    return checks


def field_errors() -> Column:
    """Errors of all fields of a line together.

    Higher-order functions evaluate their whole argument without generated code, so the list is only
    built for lines that a plain condition has found to be wrong.
    """
    checks = field_checks()
    entries = [
        f"if({condition}, named_struct('error', 'InvalidValue', 'schema', cast(null as string), "
        f"'field', '{name}', 'value', {value}, 'message', '{message}'), null)"
        for condition, message, name, value in checks
    ]
    wrong = " or ".join(f"({condition})" for condition, *_ in checks)
    return F.when(F.expr(wrong), F.expr(f"array_compact(array({', '.join(entries)}))")).otherwise(
        no_errors()
    )


def parse_enriched(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed event of each line; all malformed fields of a line are reported together."""
    width = len(LINE_FIELDS)
    index = {field.name: i for i, field in enumerate(LINE_FIELDS)}
    empty_as_null = F.transform(F.split(column, "\t", -1), lambda f: F.nullif(f, F.lit("")))
    split = lines.select(F.col(column).alias("payload"), empty_as_null.alias("fields"))
    cells = [f"{field_value(index[f.name], f)} as {f.name}" for f in ATOMIC_FIELDS]
    documents = [
        boxed_document(F.expr(raw_field(index[name]))).alias(f"{name}_document")
        for name in JSON_FIELDS
    ]
    typed = split.select("payload", "fields", F.expr(f"struct({', '.join(cells)}) as atomic"), *documents)
    listed = typed.select(
        "payload",
        "fields",
        "atomic",
        *[
            entity_list(F.col(f"{name}_document"), F.expr(raw_field(index[name])), name).alias(name)
            for name in JSON_FIELDS
        ],
    )
    checked = listed.select(
        "*",
        *[F.when(well_formed(F.col(n)), True).alias(f"well_formed_{n}") for n in JSON_FIELDS],
    )
    n_fields = F.size("fields")
    mismatch = F.concat(F.lit(f"Expected {width} fields, found "), n_fields)
    errors = (
        F.when(n_fields == 1, F.array(error("NotTSV", "Line is not tab-separated")))
        .when(n_fields != width, F.array(error("FieldNumberMismatch", mismatch)))
        .otherwise(field_errors())
    )
    no_entities = F.array().cast(f"array<{ENTITY}>")
    entities = F.concat(*[F.coalesce(F.col(name), no_entities) for name in ENTITY_ORDER])
    parsed = checked.select("payload", "atomic", entities.alias("entities"), errors.alias("errors"))
    of_good_lines = F.when(F.size("errors") == 0, F.col("entities")).otherwise(no_entities)
    return settled(parsed.withColumn("entities", of_good_lines))


def parse_self_describing(lines: DataFrame, column: str = "value") -> DataFrame:
    """One entity of each JSON line."""
    documents = lines.select(
        F.col(column).alias("payload"), parse_document(F.col(column)).alias("document")
    ).select(
        "payload",
        "document",
        F.try_variant_get("document", "$.schema", "string").alias("schema"),
        get_path(F.col("document"), ["data"]).alias("data"),
        written_field(marked(F.col("payload")), "data").alias("written"),
    )
    schema, data, document = F.col("schema"), F.col("data"), F.col("document")
    code = uri_error(schema)
    invalid_data = F.concat(F.lit("Invalid data payload: "), json_text(document))
    invalid_uri = F.concat(F.lit("Invalid schema URI: "), schema, F.lit(", code: "), code)
    errors = (
        F.when(document.isNull(), F.array(error("ParsingFailure", "Payload is not one JSON document")))
        .when(
            schema.isNull() | data.isNull(),
            F.array(error("INVALID_DATA_PAYLOAD", invalid_data)),
        )
        .when(code == INVALID_URI, F.array(error(INVALID_URI, invalid_uri, schema=schema)))
        .when(code.isNotNull(), F.array(error("INVALID_SCHEMAVER", invalid_uri, schema=schema)))
        .otherwise(no_errors())
    )
    parsed = documents.select(
        "payload",
        F.when(F.size(errors) == 0, F.array(F.struct(schema, data, F.col("written"))))
        .otherwise(F.array().cast(f"array<{ENTITY}>"))
        .alias("entities"),
        errors.alias("errors"),
    )
    return settled(parsed)
