"""Casts of JSON values to the ten target types.

Each cast gives the value as text that Spark casts to the column type without loss, or NULL where the
JSON kind does not fit. Nothing is converted across kinds: ``"12"`` is no number and ``1`` no boolean.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from distributary.functions.event_layout import SPARK_TYPES
from distributary.functions.json_values import is_number, json_text, kind_of, plain_text

UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
INSTANT_PATTERN = (
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]{0,9})?[Zz]$"
)
NUMBER_PARTS = r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]+))?$"
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"

# Names of the target types in declarations and messages.
DDL_NAMES = {
    "CHAR": "CHAR",
    "VARCHAR": "VARCHAR",
    "UUID": "UUID",
    "TIMESTAMP": "TIMESTAMP",
    "DATE": "DATE",
    "INTEGER": "INTEGER",
    "BIGINT": "BIGINT",
    "DOUBLE": "DOUBLE PRECISION",
    "BOOLEAN": "BOOLEAN",
    "JSONB": "JSONB",
}


def by_kind(type_name: Column, branches: dict[str, Column]) -> Column:
    """Pick the branch of a type that is itself data."""
    chosen = F
    for name, branch in branches.items():
        chosen = chosen.when(type_name == name, branch)
    return chosen


def parse_instant(text: Column) -> Column:
    """UTC wall time of an ISO-8601 instant that ends in Z, NULL for anything else."""
    clock = F.regexp_replace(F.upper(text), "\\.?Z$", "")
    return F.when(text.rlike(INSTANT_PATTERN), clock.try_cast("timestamp_ntz"))


def exact_digits(number: Column) -> Column:
    """Digits of a JSON number that is whole, however it is written (``1.0``, ``1e3``, ``2500e-2``); NULL for any other.

    Nothing is rounded: the point is moved over the digits. Numbers of more than 38 digits give NULL.
    """
    part = lambda group: F.regexp_extract(number, NUMBER_PARTS, group)
    fraction = part(3)
    exponent = F.when(part(4) == "", F.lit(0)).otherwise(part(4).try_cast("int"))
    digits = F.concat(part(2), fraction)
    trimmed = F.regexp_replace(digits, "0+$", "")
    zeros = exponent - F.length(fraction) + F.length(digits) - F.length(trimmed)
    shifted = F.concat(part(1), trimmed, F.repeat(F.lit("0"), zeros))
    fits = zeros.between(0, 38) & (F.length(F.ltrim(trimmed, F.lit("0"))) + zeros <= 38)
    return F.when(~number.rlike(NUMBER_PARTS), None).when(trimmed.rlike("^0*$"), "0").when(fits, shifted)


def whole_number(value: Column, kind: Column, spark_type: str, written: Column) -> Column:
    """Text of a number without fraction that fits the type; ``1.0`` and ``1e3`` are whole."""
    plain = F.when((kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$"), plain_text(value))
    digits = plain.when(is_number(kind), exact_digits(written))
    return digits.try_cast(spark_type).cast("string")


def written_text(value: Column, kind: Column, written: Column | None) -> Column:
    """Content of a string; JSON of anything else as it was written, where that is known."""
    if written is None:
        return plain_text(value)
    return F.when(kind == "STRING", plain_text(value)).when(kind.isNotNull(), F.coalesce(written, plain_text(value)))


def written_json(value: Column, kind: Column, written: Column | None) -> Column:
    """JSON of a value, as it was written where that is known; NULL for JSON null."""
    if written is None:
        return F.nullif(json_text(value), F.lit("null"))
    return F.when(kind == "STRING", json_text(value)).when(kind.isNotNull(), F.coalesce(written, json_text(value)))


def cast_text(
    value: Column,
    kind: Column,
    type_name: Column,
    length: Column,
    date_mode: str = "parse",
    written: Column | None = None,
) -> Column:
    """Text of ``value`` in its target type, NULL where it does not fit.

    ``written`` is the text of a value that is no string; it is only evaluated where the type asks for it.
    ``date_mode="reject"`` refuses every date, for loads that must behave as before.
    """
    text = plain_text(value)
    is_string = kind == "STRING"
    if date_mode == "reject":
        date = F.lit(None).cast("string")
    else:
        date = F.when(is_string & text.rlike(DATE_PATTERN), text.try_cast("date").cast("string"))
    number = written_text(value, kind, written)
    return by_kind(
        type_name,
        {
            "VARCHAR": number,
            "JSONB": written_json(value, kind, written),
            "BIGINT": whole_number(value, kind, "bigint", number),
            "INTEGER": whole_number(value, kind, "int", number),
            "DOUBLE": F.when(is_number(kind), text),
            "BOOLEAN": F.when(kind == "BOOLEAN", text),
            "TIMESTAMP": F.when(is_string, parse_instant(text).cast("string")),
            "UUID": F.when(is_string & text.rlike(UUID_PATTERN), F.lower(text)),
            "CHAR": F.when(is_string & (F.length(text) == length), text),
            "DATE": date,
        },
    )


def ddl_name(type_name: Column, length: Column) -> Column:
    """Type as it stands in a declaration, such as ``VARCHAR(42)``."""
    return by_kind(
        type_name,
        {
            name: F.concat(F.lit(f"{ddl}("), length, F.lit(")"))
            if name in ("CHAR", "VARCHAR")
            else F.lit(ddl)
            for name, ddl in DDL_NAMES.items()
        },
    )


def cast_message(value: Column, kind: Column, type_name: Column, length: Column, written: Column | None = None) -> Column:
    """Why a value was refused."""
    unparsed = F.concat(F.lit("Text '"), plain_text(value), F.lit("' could not be parsed"))
    shown = written_json(value, kind, written)
    mismatch = F.concat(F.lit("Invalid type "), ddl_name(type_name, length), F.lit(" for value "), shown)
    return F.when((type_name == "TIMESTAMP") & (kind == "STRING"), unparsed).otherwise(mismatch)


def cast_json(
    value: Column,
    type_name: str,
    length: int | None = None,
    date_mode: str = "parse",
    written: Column | None = None,
) -> tuple[Column, Column]:
    """Typed value and error of one VARIANT; both are NULL where the value is null or missing.

    ``written`` is its text in the document (``written_at``); without it numbers and keys appear as VARIANT has them.
    """
    name, size = F.lit(type_name), F.lit(length).cast("int")
    kind = kind_of(value)
    text = cast_text(value, kind, name, size, date_mode, written)
    error = F.when(kind.isNotNull() & text.isNull(), cast_message(value, kind, name, size, written))
    return text.cast(SPARK_TYPES[type_name]), error


def cell_text(value: Column, column: Column, date_mode: str = "parse", written: Column | None = None) -> Column:
    """Text of one cell, given its column as a struct of ``type`` and ``length``."""
    return cast_text(value, kind_of(value), column["type"], column["length"], date_mode, written)


def cell_failure(value: Column, column: Column, written: Column | None = None) -> Column:
    """Message and offending value of a cell that has no text although its value is not null."""
    kind = kind_of(value)
    message = cast_message(value, kind, column["type"], column["length"], written)
    shown = written_json(value, kind, written)
    return F.when(kind.isNotNull(), F.struct(message.alias("message"), shown.alias("value")))
