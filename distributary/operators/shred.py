"""Entities to typed cells, inside the row of their record.

The columns of all tables travel with the plan as one constant map from model group to column list. Cells
and errors of every entity are then plain expressions over the record's own row: no join, no shuffle,
nothing to regroup, and a record stays whole. A registry of any size can be joined instead.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from zlib import crc32

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from distributary.functions.casts import cell_failure, cell_text
from distributary.functions.errors import ERROR, error, no_errors
from distributary.functions.event_layout import EVENTS_TABLE, META_FIELDS
from distributary.functions.json_values import fields_of, let, walk, written_at
from distributary.functions.schema_uri import (
    GROUP_COLUMNS,
    KEY_COLUMNS,
    SCHEMA_KEY,
    URI_PREFIX,
    format_version,
    group_key,
    parse_uri,
    table_name,
)
from distributary.operators.constraints import cells_violation, width_violation
from distributary.operators.entities import route
from distributary.operators.registry import column_table, invalid_groups
from distributary.settings import BATCH_COLUMN

# How shredding finds the columns of a group: by a join with the registry, of any size, or from a constant
# that travels with the plan, for registries of a few megabytes.
JOIN, INLINE_MODE = "join", "inline"
MAX_INLINE_BYTES = 8 << 20

# The events table has no place for the origin of an entity.
NO_ORIGIN_COLUMNS = f'column "{META_FIELDS[0].name}" of relation "{EVENTS_TABLE}" does not exist'

NO_SCHEMAS = "SchemaListNotFound"

COLUMN = "struct<name:string,pointer:array<string>,type:string,length:int,nullable:boolean>"
GROUP = f"struct<table_name:string,problem:string,columns:array<{COLUMN}>>"
INLINE = (
    f"struct<groups:array<{GROUP}>,group_index:array<map<string,int>>,"
    f"uris:array<map<string,struct<key:{SCHEMA_KEY},group:int>>>>"
)
SHREDDED = (
    f"struct<schema:string,key:{SCHEMA_KEY},table_name:string,columns:array<string>,"
    f"cells:array<string>,errors:array<{ERROR}>,violation:string>"
)


@dataclass(frozen=True)
class Registry:
    """Tables of a registry as frames, and as a constant of the plan (``inline``) or a folder for joins."""

    schemas: DataFrame
    columns: DataFrame
    invalid: DataFrame
    inline: str | None
    folder: str | None = None

    @classmethod
    def from_schemas(
        cls,
        schemas: DataFrame,
        mode: str = JOIN,
        folder: str | None = None,
        max_bytes: int = MAX_INLINE_BYTES,
    ) -> Registry:
        """Prepare a registry; its tables are kept, every load asks for them again.

        ``join`` needs a shared ``folder``, ``inline`` refuses a registry of more than ``max_bytes``. Both give the
        same rows.
        """
        if mode not in (JOIN, INLINE_MODE):
            raise ValueError(f"mode must be {JOIN} or {INLINE_MODE}")
        if mode == JOIN and folder is None:
            raise ValueError("a joined registry needs a folder that all executors share")
        schemas = schemas.persist()
        columns = column_table(schemas).persist()
        invalid = invalid_groups(schemas, columns, [*(f.name for f in META_FIELDS), BATCH_COLUMN])
        if mode == JOIN:
            return cls(schemas, columns, invalid, None, folder)
        group = group_key(F.struct(*GROUP_COLUMNS)).alias("group")
        versions = schemas.select(
            group, table_name(F.struct(*GROUP_COLUMNS)).alias("table_name"), *KEY_COLUMNS
        )
        described = columns.select(
            group,
            "position",
            F.col("column").alias("name"),
            "pointer",
            "type",
            "length",
            "nullable",
        )
        size = sum(
            frame.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0 for frame in (versions, described)
        )
        if size > max_bytes:
            raise ValueError(f"a registry of {size} bytes is too large for the plan; use mode={JOIN!r}")
        spoiled = {r.group: r.problem for r in invalid.select(group, "problem").collect()}
        return cls(schemas, columns, invalid, inline_tables(versions.collect(), described.collect(), spoiled))

    def release(self) -> None:
        """Let go of the tables that are kept for every load."""
        self.schemas.unpersist()
        self.columns.unpersist()

    def group_table(self) -> DataFrame:
        """One row per group with its columns in order."""
        listed = F.sort_array(
            F.collect_list(
                F.struct(
                    "position",
                    F.struct(
                        F.col("column").alias("name"), "pointer", "type", "length", "nullable"
                    ).alias("column"),
                )
            )
        )
        columns = self.columns.groupBy(*GROUP_COLUMNS).agg(listed["column"].alias("columns"))
        return (
            self.schemas.select(*GROUP_COLUMNS)
            .distinct()
            .join(columns, GROUP_COLUMNS, "left")
            .join(self.invalid, GROUP_COLUMNS, "left")
            .select(
                group_key(F.struct(*GROUP_COLUMNS)).alias("group"),
                F.struct(
                    table_name(F.struct(*GROUP_COLUMNS)).alias("table_name"),
                    "problem",
                    F.coalesce("columns", F.array()).alias("columns"),
                )
                .cast(GROUP)
                .alias("known"),
            )
        )


def inline_tables(versions: list[Row], columns: list[Row], invalid: dict[str, str]) -> str:
    """JSON of all tables, for a constant of the plan: groups, and where URIs and group keys find them."""
    groups: list[dict] = []
    index: dict[str, int] = {}
    uris: dict[str, dict] = {}
    for row in sorted(versions, key=lambda r: r.group):
        if row.group not in index:
            index[row.group] = len(groups)
            table = {"table_name": row.table_name, "problem": invalid.get(row.group)}
            groups.append(table | {"columns": []})
        key = {name: row[name] for name in KEY_COLUMNS}
        version = f"{row.model}-{row.revision}-{row.addition}"
        uri = f"{URI_PREFIX}{row.vendor}/{row.name}/{row.format}/{version}"
        uris[uri] = {"key": key, "group": index[row.group]}
    for row in sorted(columns, key=lambda r: sort_position(r.position)):
        fields = ("name", "pointer", "type", "length", "nullable")
        groups[index[row.group]]["columns"].append({f: row[f] for f in fields})
    inline = {"groups": groups, "group_index": bucketed(index), "uris": bucketed(uris)}
    return json.dumps(inline, ensure_ascii=False)


def bucketed(entries: dict) -> list[dict]:
    """Entries by checksum of their key: a map is searched from end to end, so each is kept short."""
    buckets: list[dict] = [{} for _ in range(max(1, len(entries)))]
    for key, value in entries.items():
        buckets[crc32(key.encode()) % len(buckets)][key] = value
    return buckets


def lookup(buckets: Column, key: Column) -> Column:
    bucket = F.crc32(key.cast("binary")) % F.size(buckets)
    return F.get(buckets, bucket.cast("int"))[key]


def sort_position(position: Row) -> tuple:
    """Order of a column inside its table, as Spark sorts the same struct (NULL first)."""
    return tuple((value is not None, value) for value in position)


def shred_entity(
    entity: Column, key: Column, known: Column, meta: bool, atomic_schema: str, date_mode: str
) -> Column:
    """Table, cells and errors of one entity, given its key and what the registry knows of its group."""
    schema, columns = entity["schema"], known["columns"]

    def refused(name: str, message: Column) -> Column:
        return F.array(error(name, message, schema=schema))

    def written(column: Column) -> Column:
        return written_at(entity["written"], column["pointer"])

    def value_of(fields: Column, column: Column) -> Column:
        pointer = column["pointer"]
        top = fields[F.get(pointer, F.lit(0))]
        nested = walk(top, F.slice(pointer, 2, F.size(pointer)))
        return F.when(F.size(pointer) == 1, top).otherwise(nested)

    def cells_of(fields: Column) -> Column:
        return F.transform(
            columns,
            lambda column: let(value_of(fields, column), lambda v: cell_text(v, column, date_mode, written(column))),
        )

    def failure(fields: Column, column: Column) -> Column:
        def entry(found: Column) -> Column:
            pointer = F.concat(F.lit("/"), F.array_join(column["pointer"], "/"))
            wrong = error(
                "WrongType", found["message"], schema=schema, field=pointer, value=found["value"]
            )
            return F.when(found.isNotNull(), wrong)

        return let(
            let(value_of(fields, column), lambda value: cell_failure(value, column, written(column))), entry
        )

    def failures(fields: Column, cells: Column) -> Column:
        return F.array_compact(
            F.zip_with(
                columns, cells, lambda column, text: F.when(text.isNull(), failure(fields, column))
            )
        )

    def result(fields: Column, cells: Column) -> Column:
        violation = cells_violation(columns, cells, must_have_value=not meta)
        if meta:
            origin = [key["vendor"], key["name"], key["format"], format_version(key)]
            widths = [
                width_violation(value, F.lit(field.length))
                for value, field in zip(origin, META_FIELDS)
            ]
            no_origin = F.when(schema == atomic_schema, F.lit(NO_ORIGIN_COLUMNS))
            violation = F.coalesce(no_origin, *widths, violation)
        return F.struct(
            schema.alias("schema"),
            key.alias("key"),
            route(schema, atomic_schema, known["table_name"]).alias("table_name"),
            columns["name"].alias("columns"),
            cells.alias("cells"),
            F.when(F.exists(cells, lambda text: text.isNull()), failures(fields, cells))
            .otherwise(no_errors())
            .alias("errors"),
            violation.alias("violation"),
        )

    criterion = F.concat(F.lit("No schemas found for "), group_key(key), F.lit("-*-*"))
    no_text = F.array().cast("array<string>")
    refusal = F.struct(
        schema.alias("schema"),
        key.alias("key"),
        F.lit(None).cast("string").alias("table_name"),
        no_text.alias("columns"),
        no_text.alias("cells"),
        F.when(known.isNull(), refused(NO_SCHEMAS, criterion))
        .otherwise(refused("InvalidSchema", known["problem"]))
        .alias("errors"),
        F.lit(None).cast("string").alias("violation"),
    )
    shredded = let(
        fields_of(entity["data"]),
        lambda fields: let(cells_of(fields), lambda cells: result(fields, cells)),
    )
    usable = known.isNotNull() & known["problem"].isNull()
    return F.when(usable, shredded).otherwise(refusal)


def shred_entities(
    parsed: DataFrame, registry: Registry, meta: bool, atomic_schema: str, date_mode: str = "parse"
) -> DataFrame:
    """Replace ``entities`` of parsed records by their shredded form, order kept."""
    if registry.inline is None:
        return shred_joined(parsed, registry, meta, atomic_schema, date_mode)
    tables = F.from_json(F.lit(registry.inline), INLINE)

    def shred(entity: Column) -> Column:
        """A URI of the registry is looked up whole; any other one is taken apart."""
        schema = entity["schema"]
        listed = lookup(tables["uris"], schema)
        located = F.coalesce(
            listed,
            let(
                parse_uri(schema),
                lambda key: F.struct(
                    key.alias("key"), lookup(tables["group_index"], group_key(key)).alias("group")
                ),
            ),
        )

        def with_group(place: Column) -> Column:
            known = F.get(tables["groups"], place["group"])
            return let(
                F.struct(known.alias("known")),
                lambda k: shred_entity(
                    entity, place["key"], k["known"], meta, atomic_schema, date_mode
                ),
            )

        return let(located, with_group)

    return parsed.withColumn("entities", F.transform("entities", shred))


def shred_joined(
    parsed: DataFrame, registry: Registry, meta: bool, atomic_schema: str, date_mode: str = "parse"
) -> DataFrame:
    """The same by a join with the registry, which may have any size; two shuffles of the entities.

    Popular schemas are hot keys of the join; adaptive execution splits them on the side of the entities.
    """
    path = f"{registry.folder}/numbered/{uuid.uuid4().hex}"
    numbered = parsed.withColumn("row", F.monotonically_increasing_id())
    numbered.write.parquet(path)  # numbers are fixed once written; computed twice they might differ
    numbered = parsed.sparkSession.read.schema(numbered.schema).parquet(path)
    entities = numbered.select("row", F.posexplode("entities").alias("position", "entity"))
    keyed = entities.withColumn("key", parse_uri(F.col("entity.schema"))).withColumn(
        "group", group_key(F.col("key"))
    )
    shredded = keyed.join(registry.group_table(), "group", "left").select(
        "row",
        "position",
        shred_entity(
            F.col("entity"), F.col("key"), F.col("known"), meta, atomic_schema, date_mode
        ).alias("shredded"),
    )
    listed = shredded.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("position", "shredded")))["shredded"].alias("shredded")
    )
    none = F.array().cast(f"array<{SHREDDED}>")
    return (
        numbered.join(listed, "row", "left")
        .withColumn("entities", F.coalesce("shredded", none))
        .drop("row", "shredded")
    )
