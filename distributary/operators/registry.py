"""Registry as relations: schema versions, flattened properties and what changes between versions.

Everything here is an equi-join or an aggregate that combines before it shuffles, so a model group may
hold any share of the registry; only the place of a version among those of its group takes a window.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distributary.functions.column_types import (
    can_be_null,
    column_ddl,
    infer_type,
    schema_keywords,
)
from distributary.functions.errors import settled
from distributary.functions.schema_uri import (
    GROUP_COLUMNS,
    KEY_COLUMNS,
    column_name,
    format_uri,
    key_struct,
    table_name,
)
from distributary.sources.registry import with_validity

# Names of the two failures of a schema lookup.
UNKNOWN_SCHEMA, INVALID_SCHEMA = "IgluError", "InvalidSchema"

FLAT_PROPERTY = "pointer array<string>, ordinal int, required boolean, definition string"


def version() -> Column:
    """Place of a schema or property inside its model group."""
    return F.struct("revision", "addition")


def fetch_schemas(keys: DataFrame, schemas: DataFrame) -> DataFrame:
    """Documents of the wanted keys with the failure of those that are unknown or no schemas."""
    found = keys.join(schemas.select(*KEY_COLUMNS, "document"), KEY_COLUMNS, "left")
    failure = F.when(F.col("document").isNull(), UNKNOWN_SCHEMA).when(
        ~F.col("valid"), INVALID_SCHEMA
    )
    return with_validity(found).withColumn("failure", failure).drop("valid")


def latest_schemas(schemas: DataFrame) -> DataFrame:
    """Last version of each model group and how many there are."""
    return (
        schemas.groupBy(*GROUP_COLUMNS)
        .agg(
            F.max_by(key_struct(), version()).alias("latest"),
            F.count("*").alias("n_versions"),
        )
        .select(*GROUP_COLUMNS, "n_versions", format_uri(F.col("latest")).alias("latest_uri"))
    )


def order_schemas(schemas: DataFrame) -> DataFrame:
    """All versions with their ``place`` in their group, ascending by number from 1."""
    order = Window.partitionBy(*GROUP_COLUMNS).orderBy("revision", "addition")
    return schemas.withColumn("place", F.row_number().over(order))


def schemas_until(schemas: DataFrame, known: DataFrame) -> DataFrame:
    """Versions of each group up to the one in ``known`` (one key per group, itself in the registry)."""
    listed = known.join(schemas, KEY_COLUMNS, "left_semi")
    limit = listed.select(*GROUP_COLUMNS, version().alias("known_version"))
    return (
        schemas.join(limit, GROUP_COLUMNS)
        .where(version() <= F.col("known_version"))
        .drop("known_version")
    )


def flatten_schemas(schemas: DataFrame) -> DataFrame:
    """One row per leaf property of each schema, in the order they are written.

    Nested objects give longer pointers. The helper is defined in here so that it travels with the plan and
    workers need no copy of this package.
    """

    def leaves(node: dict, path: list[str], required: bool) -> Iterator[tuple]:
        types = node.get("type", [])
        types = [types] if isinstance(types, str) else types
        properties = node.get("properties")
        if set(types) <= {"object", "null"} and isinstance(properties, dict) and properties:
            needed = node.get("required") or []
            inner = required and "null" not in types
            for name, child in properties.items():
                child = child if isinstance(child, dict) else {}
                yield from leaves(child, [*path, name], inner and name in needed)
        else:
            yield path, required, json.dumps(node, ensure_ascii=False)

    def flatten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (*key, path, ordinal, required, definition)
                for *key, document in batch[[*KEY_COLUMNS, "document"]].itertuples(index=False)
                for ordinal, (path, required, definition) in enumerate(
                    leaves(json.loads(document), [], True)
                )
            ]
            names = [*KEY_COLUMNS, "pointer", "ordinal", "required", "definition"]
            yield pd.DataFrame(rows, columns=names)

    key_types = "vendor string, name string, format string, model int, revision int, addition int"
    return (
        with_validity(schemas)
        .where("valid")
        .select(*KEY_COLUMNS, "document")
        .mapInPandas(flatten, f"{key_types}, {FLAT_PROPERTY}")
    )


def remove_roots(properties: DataFrame) -> DataFrame:
    """Drop the empty pointer and every pointer that is the parent of another one in its group."""
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size("pointer") - 1), lambda n: F.slice("pointer", 1, n)
    )
    parents = properties.where(F.size("pointer") > 0).select(
        *GROUP_COLUMNS, F.explode(prefixes).alias("pointer")
    )
    return properties.where(F.size("pointer") > 0).join(
        parents, [*GROUP_COLUMNS, "pointer"], "left_anti"
    )


def union_properties(flat: DataFrame) -> DataFrame:
    """Properties of a group over all its versions, each as it first appeared."""
    first = F.struct("revision", "addition", "ordinal")
    return (
        flat.groupBy(*GROUP_COLUMNS, "pointer")
        .agg(F.min_by(F.struct("revision", "addition", "ordinal", "required", "definition"), first).alias("p"))
        .select(*GROUP_COLUMNS, "pointer", "p.*")
    )


def column_table(schemas: DataFrame) -> DataFrame:
    """Columns of every group's table, from the property first seen to the last added.

    ``position`` sorts the columns of a group: the first version's NOT NULL columns by name, its nullable
    ones by name, then additions by version in the order they are written. Additions are nullable, since
    rows loaded before them have no value.
    """
    base = schemas.groupBy(*GROUP_COLUMNS).agg(F.min(version()).alias("base"))
    united = remove_roots(union_properties(flatten_schemas(schemas)))
    properties = united.join(base, GROUP_COLUMNS).withColumn("definition", F.parse_json("definition"))
    keywords = settled(
        properties.select(
            *GROUP_COLUMNS,
            "pointer",
            "ordinal",
            "required",
            "revision",
            "addition",
            column_name(F.col("pointer")).alias("column"),
            (version() > F.col("base")).alias("added"),
            schema_keywords(F.col("definition")).alias("keywords"),
        )
    )
    described = settled(
        keywords.withColumns(
            {
                "inferred": infer_type(F.col("keywords")),
                "nullable": F.col("added") | ~F.col("required") | can_be_null(F.col("keywords")),
            }
        ).drop("keywords")
    )
    position = F.struct(
        "added",
        F.when(F.col("added"), F.col("revision")).alias("revision"),
        F.when(F.col("added"), F.col("addition")).alias("addition"),
        F.when(F.col("added"), F.col("ordinal")).alias("ordinal"),
        "nullable",
        "column",
    )
    return described.select(
        *GROUP_COLUMNS,
        "pointer",
        "column",
        "inferred.type",
        "inferred.length",
        "nullable",
        "revision",
        "addition",
        position.alias("position"),
        column_ddl(F.col("column"), F.col("inferred"), F.col("nullable")).alias("ddl"),
    )


def added_columns(columns: DataFrame, known: DataFrame) -> DataFrame:
    """Columns that came after the version in ``known``, which each group's table already reflects."""
    limit = known.select(*GROUP_COLUMNS, version().alias("known_version"))
    return (
        columns.join(limit, GROUP_COLUMNS)
        .where(version() > F.col("known_version"))
        .drop("known_version")
    )


# Fixed value: message about a document that is no schema.
NO_SCHEMA = " cannot be parsed as JSON Schema"


def invalid_groups(schemas: DataFrame, columns: DataFrame, origin: list[str]) -> DataFrame:
    """Groups that cannot be used, and why (``problem``).

    One of their documents is no schema; or two of their properties, or a property and one of the columns in
    ``origin``, have one column name; or another group has the same table name. Names differ by more than case.
    """
    broken = (
        with_validity(schemas)
        .where("not valid")
        .groupBy(*GROUP_COLUMNS)
        .agg(F.min_by(format_uri(key_struct()), version()).alias("uri"))
        .select(*GROUP_COLUMNS, F.lit(0).alias("rank"), F.concat("uri", F.lit(NO_SCHEMA)).alias("problem"))
    )
    named = columns.groupBy(*GROUP_COLUMNS, F.lower("column").alias("lowered")).agg(F.count("*").alias("n"))
    twice = named.where((F.col("n") > 1) | F.col("lowered").isin(origin)).groupBy(*GROUP_COLUMNS).agg(
        F.format_string("column %s has several properties", F.min("lowered")).alias("problem")
    )
    twice = twice.select(*GROUP_COLUMNS, F.lit(1).alias("rank"), "problem")
    groups = schemas.select(*GROUP_COLUMNS).distinct()
    table = F.lower(table_name(F.struct(*GROUP_COLUMNS))).alias("table")
    shared = groups.groupBy(table).agg(F.count("*").alias("n")).where("n > 1")
    clash = groups.withColumn("table", table).join(shared, "table").select(
        *GROUP_COLUMNS, F.lit(2).alias("rank"), F.format_string("table %s has several schemas", "table").alias("problem")
    )
    return (
        broken.union(twice).union(clash)
        .groupBy(*GROUP_COLUMNS)
        .agg(F.min_by("problem", "rank").alias("problem"))
    )


