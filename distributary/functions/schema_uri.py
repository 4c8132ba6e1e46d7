"""Schema URIs and the table and column names that come from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from distributary.functions.json_values import let

# Prefix and grammar of a schema URI, and the codes of its two faults.
URI_PREFIX = "iglu:"
NAMES_PATTERN = "[a-zA-Z0-9_.-]+/[a-zA-Z0-9_-]+/[a-zA-Z0-9_-]+/"
VERSION_PATTERN = "[1-9][0-9]*-(0|[1-9][0-9]*)-(0|[1-9][0-9]*)"
URI_PATTERN = f"^{URI_PREFIX}{NAMES_PATTERN}{VERSION_PATTERN}$"
SHORT_URI_PATTERN = URI_PATTERN.replace("*", "{0,8}")
INVALID_URI = "INVALID_IGLUURI"
INVALID_VERSION = "INVALID_SCHEMAVER"

SCHEMA_KEY = (
    "struct<vendor:string,name:string,format:string,model:int,revision:int,addition:int>"
)
KEY_COLUMNS = ["vendor", "name", "format", "model", "revision", "addition"]
GROUP_COLUMNS = ["vendor", "name", "model"]


def parse_uri(uri: Column) -> Column:
    """Schema key of a URI, or NULL where the text is not one."""
    names = F.split(F.substring(uri, len(URI_PREFIX) + 1, 2**31 - 1), "/")

    def key(parts: Column) -> Column:
        numbers = [parts["version"][i].try_cast("int") for i in range(3)]
        struct = F.struct(
            parts["names"][0].alias("vendor"),
            parts["names"][1].alias("name"),
            parts["names"][2].alias("format"),
            *[n.alias(c) for n, c in zip(numbers, KEY_COLUMNS[3:])],
        )
        in_range = [n.isNotNull() for n in numbers]
        return F.when(in_range[0] & in_range[1] & in_range[2], struct)

    def split_version(parts: Column) -> Column:
        return let(
            F.struct(parts.alias("names"), F.split(parts[3], "-").alias("version")), key
        )

    return F.when(uri.rlike(URI_PATTERN), let(names, split_version))


def is_uri(uri: Column) -> Column:
    """True where the text is a full schema URI. Only long version numbers need parsing to know."""
    return uri.rlike(SHORT_URI_PATTERN) | (uri.rlike(URI_PATTERN) & parse_uri(uri).isNotNull())


def uri_error(uri: Column) -> Column:
    """Code of what is wrong with a URI, NULL for a right one."""
    return F.when(
        ~F.coalesce(is_uri(uri), F.lit(False)),
        F.when(uri.rlike(f"^{URI_PREFIX}{NAMES_PATTERN}[^/]*$"), INVALID_VERSION).otherwise(
            INVALID_URI
        ),
    )


def joined(separator: str, *parts: Column) -> Column:
    """Parts as text with a separator; NULL where one of them is."""
    pieces = [piece for part in parts for piece in (F.lit(separator), part.cast("string"))]
    return F.concat(*pieces[1:])


def format_version(key: Column) -> Column:
    return joined("-", key["model"], key["revision"], key["addition"])


def format_uri(key: Column) -> Column:
    """URI of a schema key."""
    return F.concat(
        F.lit(URI_PREFIX),
        joined("/", key["vendor"], key["name"], key["format"], format_version(key)),
    )


def key_struct(prefix: str = "") -> Column:
    """Schema key built from the six key columns of a frame."""
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in KEY_COLUMNS])


def snake_case(text: Column) -> Column:
    """Words of a camel-case name joined by underscores, lower-case, without dots or dashes."""
    split_acronym = F.regexp_replace(text, "([A-Z]+)([A-Z][a-z])", "$1_$2")
    split_words = F.regexp_replace(split_acronym, "([a-z0-9])([A-Z])", "$1_$2")
    return F.lower(F.regexp_replace(split_words, "[.-]", "_"))


def column_name(pointer: Column) -> Column:
    """Column of a property, from the array of its path steps."""
    return F.array_join(F.transform(pointer, snake_case), ".")


def table_name(key: Column) -> Column:
    """Table of a model group: vendor, name and model, whatever the revision."""
    vendor = F.lower(F.regexp_replace(key["vendor"], "[.-]", "_"))
    return joined("_", vendor, snake_case(key["name"]), key["model"])


def group_key(key: Column) -> Column:
    """One text for a model group; a slash cannot occur inside its parts."""
    return joined("/", key["vendor"], key["name"], key["model"])
