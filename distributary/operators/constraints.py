"""Constraints a table puts on its rows, checked before anything is written.

Spark fails a whole job on an overlong value and does not enforce NOT NULL, so a row that breaks a
constraint has to be known beforehand. A check gives the message of the violation or NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from distributary.functions.event_layout import ATOMIC_FIELDS

# Fixed value: type name inside the width message.
WIDTH_NAMES = {"VARCHAR": "character varying", "CHAR": "character"}


def width_violation(text: Column, length: Column, kind: str = "VARCHAR") -> Column:
    """Trailing blanks do not count, as when a table cuts them off."""
    message = F.concat(F.lit(f"value too long for type {WIDTH_NAMES[kind]}("), length, F.lit(")"))
    too_long = (F.length(text) > length) & (F.length(F.rtrim(text)) > length)
    return F.when(too_long, message)


def null_violation(value: Column, name: Column) -> Column:
    message = F.concat(
        F.lit('null value in column "'), name, F.lit('" violates not-null constraint')
    )
    return F.when(value.isNull(), message)


def first_violation(checks: Column) -> Column:
    return F.get(F.array_compact(checks), F.lit(0))


def atomic_violation(atomic: str) -> Column:
    """First violation of a row of the events table: widths of all columns, then missing values."""
    widths = [
        f"if(length(rtrim({atomic}.{f.name})) > {f.length}, "
        f"'value too long for type {WIDTH_NAMES[f.kind]}({f.length})', null)"
        for f in ATOMIC_FIELDS
        if f.length is not None
    ]
    nulls = [
        f"if({atomic}.{f.name} is null, "
        f"'null value in column \"{f.name}\" violates not-null constraint', null)"
        for f in ATOMIC_FIELDS
        if not f.nullable
    ]
    return F.expr(f"coalesce({', '.join([*widths, *nulls])})")


def cells_violation(columns: Column, cells: Column, must_have_value: bool) -> Column:
    """First violation of an entity's row, from its column list and the texts of its cells."""
    widths = F.zip_with(
        columns,
        cells,
        lambda c, text: F.when(c["type"] == "VARCHAR", width_violation(text, c["length"])),
    )
    nulls = F.zip_with(
        columns, cells, lambda c, text: F.when(~c["nullable"], null_violation(text, c["name"]))
    )
    violations = [first_violation(widths), first_violation(nulls)]
    if must_have_value:
        empty = ~F.exists(cells, lambda text: text.isNotNull())
        violations.append(F.when(empty, F.lit("row has no value to insert")))
    return F.coalesce(*violations)
