"""Record bytes to payload text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# How records that are not UTF-8 are treated: bytes replaced, or the record refused.
REPLACE, STRICT = "replace", "strict"

# Fixed value: message of a refused record.
NOT_UTF8 = "Cannot deserialize payload as UTF-8"


def decode_payload(record: Column) -> Column:
    """Text of a record; malformed bytes become replacement characters."""
    return F.make_valid_utf8(record.cast("string"))


def base64_line(record: Column) -> Column:
    """Base64 of the bytes as one line."""
    return F.translate(F.base64(record), "\r\n", "")


def decode_strict(record: Column) -> tuple[Column, Column]:
    """Text of a record and, where its bytes are not UTF-8, the base64 of them instead."""
    text = record.cast("string")
    valid = F.is_valid_utf8(text)
    return F.when(valid, text), F.when(~valid, base64_line(record))
