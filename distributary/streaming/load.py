"""Loading: shred a batch once, bring the tables up to date, append to each of them.

A batch is written to a shared folder, clustered by target table, in one pass over its input. From there
each table is filled by a job that reads nothing but its own partition. An event with any failure is in no
table.

Batches become visible whole (``plans.batches``): the rows of an attempt carry its token, and one row in the manifest,
written after all tables, commits it. ``load`` is one-shot: it loads what it is given, each time. A stream may replay
its last batch after a failure; what the first attempt wrote stays unseen, and a batch that was committed is not loaded
again. The stream's identity lies in its checkpoint: a new checkpoint is a new stream. Tables therefore hold every event
exactly once per load or stream. Bad rows go to their sink before the commit, at least once.

A registry grows while a stream runs. It is reloaded when it is older than ``max_age`` seconds, and at once when a batch
names schemas that were not asked for in that time: what a reload does not find is remembered as missing, so that a
schema nobody lists costs one reload per ``max_age``, whatever the number of batches that name it. A loader that can reload
looks through the text of a batch before it shreds it (``probe``). A batch is shredded again only if what the probe missed
made a reload that found something that the batch names. Entities whose version is still unlisted load by the columns of
their group that are known, and are counted in ``unlisted``.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from distributary.functions.event_layout import EVENTS_TABLE, META_FIELDS
from distributary.functions.schema_uri import (
    NAMES_PATTERN,
    URI_PREFIX,
    VERSION_PATTERN,
    format_uri,
    group_key,
    key_struct,
    parse_uri,
)
from distributary.operators.shred import Registry
from distributary.operators.state import MISSING, OUTDATED, key_states, state_from_comments
from distributary.plans.batches import BATCH_COLUMN, commit, create_manifest, last_committed
from distributary.plans.shredding import BAD_ROWS, shred, table_rows
from distributary.plans.tables import create_events_table, prepare_tables, table_comments
from distributary.settings import Settings, configure, work_dir
from distributary.streaming.sinks import BadSink, DiscardingSink

# Missing schemas remembered at a time; beyond it they are taken for missing until the next reload by age.
REMEMBERED = 10_000

# Schema URIs in the text of a line, wherever they stand; the ends of longer texts may follow.
URI_IN_TEXT = f"{URI_PREFIX}{NAMES_PATTERN}{VERSION_PATTERN}"

log = logging.getLogger("distributary")


class Loader:
    """Loads batches of lines into the tables of one database."""

    def __init__(
        self,
        spark: SparkSession,
        registry: Registry,
        settings: Settings,
        database: str,
        bad_sink: BadSink | None = None,
        folder: str | None = None,
        parallel_tables: int = 4,
        reload: Callable[[], Registry] | None = None,
        max_age: float = 600.0,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.spark = configure(spark)
        self.registry = registry
        self.settings = settings
        self.database = database
        self.bad_sink = DiscardingSink() if bad_sink is None else bad_sink
        self.folder = folder or f"{work_dir(spark)}/{database}"
        self.parallel_tables = parallel_tables
        self.reload, self.max_age, self.clock = reload, max_age, clock
        self.loaded_at = clock()
        self.missing: dict[str, float] = {}
        self.unlisted = 0
        self.probing = False
        create_manifest(spark, database)
        if settings.includes_meta:
            create_events_table(spark, database)

    def load(self, lines: DataFrame) -> None:
        """Load these lines, once more each time."""
        self.load_staged(lines, f"load-{uuid.uuid4().hex}", 0)

    def load_batch(self, lines: DataFrame, batch_id: int, stream: str) -> None:
        """Load one batch of a stream, unless it was committed already."""
        if last_committed(self.spark, self.database, stream) < batch_id:
            self.load_staged(lines, stream, batch_id)

    def load_staged(self, lines: DataFrame, stream: str, batch_id: int) -> None:
        token = uuid.uuid4().hex
        paths = []

        def stage() -> DataFrame | None:
            paths.append(f"{self.folder}/staging/{token}-{len(paths)}")
            return self.stage(lines, paths[-1])

        if self.reload and self.clock() - self.loaded_at >= self.max_age:
            self.renew_registry()
        self.probing = self.reload is not None
        try:
            staged = stage()
            if staged is None:
                staged = stage()
            named = self.unlisted_schemas(staged)
            if self.learns(named):
                staged = stage()
                named = self.unlisted_schemas(staged)
            versions = sum(1 for row in named if not row.unknown)
            if versions:
                log.warning("%d schema versions are not listed; known columns are loaded", versions)
                self.unlisted += versions
            tables = [*self.update_tables(staged), BAD_ROWS]
            with ThreadPoolExecutor(self.parallel_tables) as pool:
                list(pool.map(lambda table: self.fill(staged, table, batch_id, token), tables))
            commit(self.spark, self.database, token, stream, batch_id)
        finally:
            for path in paths:
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def renew_registry(self) -> None:
        assert self.reload is not None
        before, self.registry = self.registry, self.reload()
        if before is not self.registry:
            before.release()
        self.loaded_at = self.clock()

    def unlisted_schemas(self, staged: DataFrame) -> list[Row]:
        """Schemas that the batch names and the registry does not list, and whether their whole group is unknown."""
        listed = self.registry.schemas.select(format_uri(key_struct()).alias("schema"))
        named = staged.select(F.col("meta.schema").alias("schema"), F.lit(False).alias("unknown"))
        named = named.where("schema is not null").distinct().join(listed, "schema", "left_anti")
        unknown = staged.where(F.col("table_name") == BAD_ROWS).select(F.explode("unknown").alias("schema"), F.lit(True).alias("unknown"))
        return named.union(unknown.distinct()).limit(REMEMBERED).collect()

    def learns(self, named: list[Row]) -> bool:
        """Ask the registry for schemas not known to be missing; True if it now lists any that the batch names."""
        now = self.clock()
        self.missing = {schema: at for schema, at in self.missing.items() if now - at < self.max_age}
        asked = {row.schema for row in named} - self.missing.keys()
        if not asked or self.reload is None or len(self.missing) >= REMEMBERED:
            return False
        self.renew_registry()
        wanted = self.spark.createDataFrame([(row.schema, row.unknown) for row in named], "schema string, unknown boolean")
        listed = self.registry.schemas.select(format_uri(key_struct()).alias("schema"), group_key(key_struct()).alias("group"))
        wanted = wanted.withColumn("group", group_key(parse_uri(F.col("schema"))))
        groups = listed.select(F.col("group"), F.lit(True).alias("known")).distinct()
        checked = wanted.join(listed.select("schema", F.lit(True).alias("listed")).distinct(), "schema", "left")
        checked = checked.join(groups, "group", "left").select("schema", "unknown", "listed", "known").collect()
        self.missing.update({row.schema: now for row in checked if not row.listed})
        return any(row.listed or (row.unknown and row.known) for row in checked)

    def probe(self, lines: DataFrame) -> list[Row]:
        """Unlisted schemas found early: of each schema URI in the text that is neither listed nor known to be missing, one line is shredded.

        A URI need not stand for an entity, may be escaped, and its line may be bad for another reason: what is named here is
        named by the batch, but the batch can name more.
        """
        listed = self.registry.schemas.select(format_uri(key_struct()).alias("uri"))
        missing = self.spark.createDataFrame([(schema,) for schema in self.missing], "uri string")
        found = lines.select("value", F.explode(F.array_distinct(F.regexp_extract_all("value", F.lit(URI_IN_TEXT), F.lit(0)))).alias("uri"))
        found = found.join(F.broadcast(listed.union(missing)), "uri", "left_anti")
        examples = found.groupBy("uri").agg(F.first("value").alias("value")).limit(REMEMBERED).select("value").collect()
        if not examples:
            return []
        few = self.spark.createDataFrame(examples, "value string")
        return self.unlisted_schemas(table_rows(shred(few, self.registry, self.settings), self.settings))

    def stage(self, lines: DataFrame, path: str) -> DataFrame | None:
        """Shred a batch and write all its rows, one folder per target table; None if a probe of it taught the registry something.

        Rows are rebalanced by table first: files follow the size of a table, and a large one is split.
        """
        if self.probing:
            self.probing = False
            if self.learns(self.probe(lines)):
                return None
        rows = table_rows(shred(lines, self.registry, self.settings), self.settings)
        clustered = rows.hint("rebalance", F.col("table_name"))
        clustered.write.mode("overwrite").partitionBy("table_name").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def update_tables(self, staged: DataFrame) -> list[str]:
        """Create and evolve what the batch needs; names of all tables it fills."""
        keys = (
            staged.select("table_name", F.col("meta.schema").alias("schema"))
            .where("schema is not null")
            .distinct()
            .select("table_name", parse_uri(F.col("schema")).alias("key"))
            .select("table_name", "key.*")
        )
        checked = key_states(keys, self.state(), self.settings.atomic_schema)
        wanted = (
            checked.groupBy("table_name")
            .agg(
                F.bool_or(F.col("table_state") == MISSING).alias("missing"),
                F.bool_or(F.col("table_state") == OUTDATED).alias("outdated"),
            )
            .orderBy("table_name")
            .collect()
        )
        prepare_tables(
            self.spark, self.registry, self.database, wanted, self.settings.includes_meta
        )
        tables = {row.table_name for row in wanted}
        if self.settings.includes_meta:
            tables.add(EVENTS_TABLE)
        elif EVENTS_TABLE in tables:
            create_events_table(self.spark, self.database)
        return sorted(tables)

    def state(self) -> DataFrame:
        """Schema versions the tables reflect, from their comments."""
        comments = table_comments(self.spark, self.database)
        return state_from_comments(comments, self.registry.schemas)

    def fill(self, staged: DataFrame, table: str, batch_id: int, token: str) -> None:
        """Append the staged rows of one table, or hand over the bad rows."""
        rows = staged.where(F.col("table_name") == table)
        if table == BAD_ROWS:
            self.bad_sink(rows.select(F.col("bad_row").alias("value")), batch_id)
            return
        target = f"{self.database}.{table}"
        fields = self.spark.table(target).schema.fields[:-1]
        is_event = self.settings.includes_meta and table == EVENTS_TABLE
        source = rows.select("atomic.*") if is_event else entity_columns(rows)
        columns = [cell(f.name, source.columns).cast(f.dataType).alias(f.name) for f in fields]
        source.select(*columns, F.lit(token).alias(BATCH_COLUMN)).write.insertInto(target)

    def stream(
        self,
        lines: DataFrame,
        checkpoint: str,
        once: bool = False,
        interval: str = "10 seconds",
    ) -> StreamingQuery:
        """Load a stream; ``once`` ends after what is there now. Progress is noted after the tables."""
        trigger = {"availableNow": True} if once else {"processingTime": interval}
        identity = stream_identity(self.spark, checkpoint)
        writer = lines.writeStream.foreachBatch(
            lambda batch, batch_id: self.load_batch(batch, batch_id, identity)
        )
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_if_there(spark: SparkSession, path: str) -> list[Row]:
    """Rows of a small table, none where the path does not exist; every other fault is raised."""
    try:
        return spark.read.parquet(path).collect()
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream that a checkpoint belongs to; it lives and goes with the checkpoint."""
    path = f"{checkpoint.rstrip('/')}/loader"
    known = read_if_there(spark, path)
    if known:
        return known[0].identity
    identity = uuid.uuid4().hex
    spark.createDataFrame([(identity,)], "identity string").coalesce(1).write.parquet(path)
    return identity


def entity_columns(rows: DataFrame) -> DataFrame:
    """Origin of each entity and its cells by column name."""
    cells = F.map_from_arrays("columns", "cells").alias("cells")
    return rows.select(*[F.col(f"meta.{f.name}").alias(f.name) for f in META_FIELDS], cells)


def cell(name: str, columns: list[str]) -> Column:
    """Value of one target column; a column the entity knows nothing of stays NULL."""
    return F.col(name) if name in columns else F.try_element_at("cells", F.lit(name))
