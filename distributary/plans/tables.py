"""Target tables in the catalog: creation, evolution, comments and description.

Statements run on the driver once per batch and table; rows never pass through here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from distributary.functions.event_layout import (
    ATOMIC_FIELDS,
    EVENTS_TABLE,
    META_FIELDS,
    Field,
)
from distributary.functions.schema_uri import GROUP_COLUMNS, table_name
from distributary.operators.registry import latest_schemas
from distributary.plans.batches import BATCH_COLUMN, MANIFEST
from distributary.operators.shred import Registry

# Columns that once were narrower, and their width now.
WIDENED_COLUMNS = [
    "user_ipaddress",
    "domain_userid",
    "network_userid",
    "refr_domain_userid",
    "domain_sessionid",
]
WIDENED_TYPE = "VARCHAR(128)"


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def full_name(database: str, table: str) -> str:
    return f"{quote(database)}.{quote(table)}"


def column_line(field: Field, nullable: bool) -> str:
    return f"{quote(field.name)} {field.table_type}{'' if nullable else ' NOT NULL'}"


def create_events_table(spark: SparkSession, database: str) -> bool:
    """Create the events table where it is missing; True if it was."""
    if spark.catalog.tableExists(f"{database}.{EVENTS_TABLE}"):
        return False
    columns = ", ".join(column_line(f, f.nullable) for f in ATOMIC_FIELDS)
    create_table(spark, database, EVENTS_TABLE, columns)
    return True


def create_table(spark: SparkSession, database: str, table: str, columns: str) -> None:
    """A table whose rows become visible by batch."""
    stored = f"({columns}, {quote(BATCH_COLUMN)} STRING) USING parquet PARTITIONED BY ({quote(BATCH_COLUMN)})"
    spark.sql(f"CREATE TABLE {full_name(database, table)} {stored}")


def table_fields(registry: Registry, table: str) -> list[Row]:
    """Columns of one table in order; as many rows as the table is wide."""
    key = F.struct(*GROUP_COLUMNS)
    rows = registry.columns.where(table_name(key) == table).orderBy("position")
    return rows.select(F.col("column").alias("name"), "type", "length", "nullable").collect()


def as_field(row: Row) -> Field:
    return Field(row.name, row.type, row.length, row.nullable)


def create_entity_table(
    spark: SparkSession, registry: Registry, database: str, table: str, meta: bool
) -> None:
    """Create the table of a model group with the columns of all its versions."""
    fields = [as_field(r) for r in table_fields(registry, table)]
    lines = [column_line(f, True) for f in META_FIELDS] if meta else []
    lines += [column_line(f, f.nullable) for f in fields]
    create_table(spark, database, table, ", ".join(lines))
    comment_table(spark, registry, database, table)


def alter_entity_table(spark: SparkSession, registry: Registry, database: str, table: str) -> None:
    """Add the columns of newer versions; they are nullable, earlier rows read as NULL."""
    name = full_name(database, table)
    present = set(spark.table(name).columns)
    fields = [as_field(r) for r in table_fields(registry, table)]
    added = [column_line(f, True) for f in fields if f.name not in present]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    comment_table(spark, registry, database, table)


def comment_table(spark: SparkSession, registry: Registry, database: str, table: str) -> None:
    """Note the latest schema of the group on its table."""
    key = F.struct(*GROUP_COLUMNS)
    latest = latest_schemas(registry.schemas.where(table_name(key) == table)).select("latest_uri")
    for row in latest.collect():
        set_comment(spark, database, table, row.latest_uri)


def set_comment(spark: SparkSession, database: str, table: str, comment: str) -> None:
    """Comment a table. ``COMMENT ON TABLE`` would turn its CHAR and VARCHAR columns into strings without width."""
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {full_name(database, table)} SET TBLPROPERTIES ('comment' = '{text}')")


def prepare_tables(
    spark: SparkSession, registry: Registry, database: str, wanted: Iterable[Row], meta: bool
) -> None:
    """Bring tables up to the registry: rows with ``table_name``, ``missing`` and ``outdated``."""
    for row in wanted:
        if row.missing and not spark.catalog.tableExists(f"{database}.{row.table_name}"):
            create_entity_table(spark, registry, database, row.table_name, meta)
        elif row.missing or row.outdated:
            alter_entity_table(spark, registry, database, row.table_name)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Tables of events and entities."""
    return sorted(t.name for t in spark.catalog.listTables(database) if t.name != MANIFEST)


def table_comments(spark: SparkSession, database: str) -> DataFrame:
    """Name and comment of every table."""
    rows = [(t.name, t.description or None) for t in spark.catalog.listTables(database) if t.name != MANIFEST]
    return spark.createDataFrame(rows, "table_name string, comment string")


def declared_columns(spark: SparkSession, database: str, table: str) -> list[tuple[str, str]]:
    """Columns of a table in order as they were declared, widths of texts included; file tables take NULL in all of them."""
    found = []
    for row in spark.sql(f"DESCRIBE TABLE {full_name(database, table)}").collect():
        if not row.col_name or row.col_name.startswith("#"):
            break
        if row.col_name != BATCH_COLUMN:
            found.append((row.col_name, row.data_type))
    return found


def describe_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Columns of a table in order with their declared types."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(declared_columns(spark, database, table))]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def widen_columns(
    spark: SparkSession,
    database: str,
    table: str,
    columns: list[str] | None = None,
    type_text: str = WIDENED_TYPE,
) -> None:
    """Give text columns of a table a wider type: Spark cannot do so in place, so the table is copied and takes its name.

    The copy keeps the comment, the batches and all other columns. Names are only exchanged once the copy is whole; a
    call after one that stopped half way goes on from there. No load may run meanwhile.
    """
    copy, narrow = f"{table}__wide", f"{table}__narrow"
    exists = lambda name: spark.catalog.tableExists(f"{database}.{name}")
    if exists(table) and not exists(narrow):
        if exists(copy):
            spark.sql(f"DROP TABLE {full_name(database, copy)}")
        wider = set(columns or WIDENED_COLUMNS)
        declared = declared_columns(spark, database, table)
        lines = [f"{quote(name)} {type_text if name in wider else kind}" for name, kind in declared]
        create_table(spark, database, copy, ", ".join(lines))
        spark.table(full_name(database, table)).write.insertInto(f"{database}.{copy}")
        comment = spark.catalog.getTable(f"{database}.{table}").description
        if comment:
            set_comment(spark, database, copy, comment)
        spark.sql(f"ALTER TABLE {full_name(database, table)} RENAME TO {full_name(database, narrow)}")
    if not exists(table):
        spark.sql(f"ALTER TABLE {full_name(database, copy)} RENAME TO {full_name(database, table)}")
    spark.sql(f"DROP TABLE IF EXISTS {full_name(database, narrow)}")
