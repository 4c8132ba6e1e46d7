"""The scalar part of an event as a row of the events table."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.functions.casts import UUID_PATTERN, parse_instant
from distributary.functions.errors import error, errors_where
from distributary.functions.event_layout import (
    ATOMIC_FIELDS,
    ATOMIC_STRING_LIMIT,
    Field,
)
from distributary.functions.json_values import (
    get_path,
    is_number,
    json_text,
    kind_of,
    plain_text,
)


NO_LENGTHS: Mapping[str, int] = MappingProxyType({})


def kept_length(name: str, lengths: Mapping[str, int]) -> int:
    """Characters kept of a text of the event: by column where told, else one limit for all."""
    return lengths.get(name, ATOMIC_STRING_LIMIT)


def shred_atomic(atomic: str, lengths: Mapping[str, int] = NO_LENGTHS) -> Column:
    """Row of the events table, from the column with the typed fields of a parsed line."""
    cells = [
        f"substring({atomic}.{f.name}, 1, {kept_length(f.name, lengths)}) as {f.name}"
        if f.kind in ("VARCHAR", "CHAR")
        else f"{atomic}.{f.name} as {f.name}"
        for f in ATOMIC_FIELDS
    ]
    return F.expr(f"struct({', '.join(cells)})")


def shred_atomic_json(
    events: DataFrame, document: str, atomic_schema: str, lengths: Mapping[str, int] = NO_LENGTHS
) -> DataFrame:
    """The same row from an event held as a JSON object (VARIANT), with the errors of all its fields.

    Only the id and the times are checked here: other values pass by their JSON kind, lists and objects
    are left out.
    """
    cells, checks = [], []
    for field in ATOMIC_FIELDS:
        value = get_path(F.col(document), [field.name])
        cell, expected = json_cell(value, field, kept_length(field.name, lengths))
        cells.append(cell.alias(field.name))
        if expected is not None:
            entry = error(
                "WrongType",
                F.lit(expected),
                schema=F.lit(atomic_schema),
                field=F.lit(field.name),
                value=json_text(value),
            )
            checks.append((kind_of(value).isNotNull() & cell.isNull(), entry))
    return events.withColumns(
        {"atomic": F.struct(*cells), "atomic_errors": errors_where(*checks)}
    )


def json_cell(value: Column, field: Field, limit: int) -> tuple[Column, str | None]:
    """Cell of one field, and the name of the form it must have where that is checked."""
    kind, text = kind_of(value), plain_text(value)
    if field.kind == "UUID":
        return F.when((kind == "STRING") & text.rlike(UUID_PATTERN), F.lower(text)), "uuid"
    if field.name.endswith("_tstamp"):
        return F.when(kind == "STRING", parse_instant(text)), "date-time"
    if field.kind == "BOOLEAN":
        return F.when(kind == "BOOLEAN", text.try_cast("boolean")), None
    if field.kind in ("INTEGER", "DOUBLE"):
        return F.when(is_number(kind), text.try_cast(field.spark_type)), None
    return F.when(~kind.rlike("^(ARRAY|OBJECT)"), F.substring(text, 1, limit)), None


def choose_errors(entity_errors: Column, atomic_errors: Column) -> Column:
    """Errors of the event's own fields count only where no entity failed."""
    return F.when(F.size(entity_errors) > 0, entity_errors).otherwise(atomic_errors)
