"""Relational type of a property, from the keywords of its JSON Schema.

The keywords are columns of the property table (see ``schema_keywords``): one CASE chain gives every
type, so inference over a registry is a projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from distributary.functions.casts import ddl_name
from distributary.functions.json_values import is_number, kind_of, plain_text

# Width of a text column without declared length, largest 32-bit number.
DEFAULT_VARCHAR = 4096
MAX_INTEGER = 2147483647

KEYWORDS = (
    "struct<types:array<string>,format_kw:string,min_length:int,max_length:int,"
    "maximum:decimal(38,0),maximum_is_int:boolean,multiple_of_is_int:boolean,"
    "enum:array<struct<kind:string,text:string>>>"
)


def whole(kind: Column) -> Column:
    """True for a number written without fraction or exponent."""
    return (kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$")


def schema_keywords(definition: Column) -> Column:
    """Keywords of one property definition (VARIANT) that decide its type."""

    def keyword(name: str) -> Column:
        return F.try_variant_get(definition, f"$.{name}", "variant")

    def integer(name: str) -> Column:
        return F.when(whole(kind_of(keyword(name))), plain_text(keyword(name)).try_cast("int"))

    type_kw, maximum = keyword("type"), keyword("maximum")
    one_type = F.when(kind_of(type_kw) == "STRING", F.array(plain_text(type_kw)))
    many_types = F.try_variant_get(type_kw, "$", "array<string>")
    enum = F.transform(
        F.try_variant_get(keyword("enum"), "$", "array<variant>"),
        lambda item: F.struct(kind_of(item).alias("kind"), plain_text(item).alias("text")),
    )
    return F.struct(
        F.coalesce(one_type, many_types).alias("types"),
        plain_text(keyword("format")).alias("format_kw"),
        integer("minLength").alias("min_length"),
        integer("maxLength").alias("max_length"),
        F.when(whole(kind_of(maximum)), plain_text(maximum).try_cast("decimal(38,0)")).alias(
            "maximum"
        ),
        F.when(is_number(kind_of(maximum)), whole(kind_of(maximum))).alias("maximum_is_int"),
        F.when(
            is_number(kind_of(keyword("multipleOf"))), whole(kind_of(keyword("multipleOf")))
        ).alias("multiple_of_is_int"),
        enum.alias("enum"),
    )


def infer_type(keywords: Column) -> Column:
    """Type name and length; the first rule that fits decides, JSONB where none does."""
    types, enum = keywords["types"], keywords["enum"]
    max_length, min_length = keywords["max_length"], keywords["min_length"]
    plain_types = F.array_remove(types, "null")
    values = F.filter(enum, lambda item: item["kind"].isNotNull())

    def is_type(name: str) -> Column:
        return F.coalesce((F.size(plain_types) == 1) & F.array_contains(plain_types, name), F.lit(False))

    def some(test) -> Column:
        return F.coalesce(F.exists(values, test), F.lit(False))

    def every(test) -> Column:
        return F.coalesce((F.size(values) > 0) & F.forall(values, test), F.lit(False))

    def fits(spark_type: str):
        return lambda item: whole(item["kind"]) & item["text"].try_cast(spark_type).isNotNull()

    def numeric(item: Column) -> Column:
        return is_number(item["kind"])

    enum_traits = [
        some(numeric),
        some(lambda item: ~numeric(item)),
        some(lambda item: item["kind"] == "BOOLEAN"),
    ]
    mixed_enum = reduce(lambda a, b: a + b, [t.cast("int") for t in enum_traits]) >= 2
    product = (F.size(plain_types) > 1) | F.array_contains(types, "array")
    no_type = types.isNull()

    def has_format(name: str) -> Column:
        return is_type("string") & (keywords["format_kw"] == name)

    def typed(name: str, length: Column | None = None) -> Column:
        size = F.lit(None) if length is None else length
        return F.struct(F.lit(name).alias("type"), size.cast("int").alias("length"))

    longest = F.array_max(F.transform(values, lambda item: F.length(item["text"])))
    big_maximum = keywords["maximum_is_int"] & (keywords["maximum"] > MAX_INTEGER)
    return (
        F.when(mixed_enum, typed("JSONB"))
        .when(product, typed("JSONB"))
        .when(has_format("date-time"), typed("TIMESTAMP"))
        .when(has_format("date"), typed("DATE"))
        .when(is_type("integer") & big_maximum, typed("BIGINT"))
        .when(is_type("integer") & keywords["maximum_is_int"].isNotNull(), typed("INTEGER"))
        .when(is_type("integer") & enum.isNull(), typed("BIGINT"))
        .when(is_type("integer") & every(fits("int")), typed("INTEGER"))
        .when(is_type("integer"), typed("BIGINT"))
        .when(no_type & every(fits("int")), typed("INTEGER"))
        .when(no_type & every(fits("bigint")), typed("BIGINT"))
        .when(keywords["multiple_of_is_int"], typed("INTEGER"))
        .when(is_type("number"), typed("DOUBLE"))
        .when(is_type("boolean"), typed("BOOLEAN"))
        .when(is_type("string") & (min_length == max_length), typed("CHAR", min_length))
        .when(has_format("uuid"), typed("UUID"))
        .when(is_type("string") & max_length.isNotNull(), typed("VARCHAR", max_length))
        .when(is_type("string") & enum.isNull(), typed("VARCHAR", F.lit(DEFAULT_VARCHAR)))
        .when(every(lambda item: item["kind"] == "STRING"), typed("VARCHAR", longest))
        .otherwise(typed("JSONB"))
    )


def can_be_null(keywords: Column) -> Column:
    """True where the schema admits null, by its type or among its enumerated values."""
    null_value = F.exists(keywords["enum"], lambda item: item["kind"].isNull())
    null_type = F.array_contains(keywords["types"], "null")
    return F.coalesce(null_value, F.lit(False)) | F.coalesce(null_type, F.lit(False))


def column_ddl(name: Column, inferred: Column, nullable: Column) -> Column:
    """Declaration of one column."""
    return F.concat_ws(
        " ",
        F.concat(F.lit('"'), name, F.lit('"')),
        ddl_name(inferred["type"], inferred["length"]),
        F.when(nullable, "NULL").otherwise("NOT NULL"),
    )
