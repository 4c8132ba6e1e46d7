"""The registered queries: each runs an operator of the engine over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs
from catalog.inputs import (
    ATOMIC_SCHEMA,
    JSON_SETTINGS,
    SETTINGS,
    enriched_lines,
    lines_of,
    registry,
    schema_document,
    schemas,
    spread,
    table,
    uuid_of,
)
from distributary.functions.casts import cast_json
from distributary.functions.errors import settled
from distributary.functions.event_layout import ATOMIC_FIELDS, EVENTS_TABLE
from distributary.functions.json_values import get_path, marked, parse_document, plain_text, written_at
from distributary.functions.payload import decode_payload, decode_strict
from distributary.functions.schema_uri import (
    GROUP_COLUMNS,
    KEY_COLUMNS,
    URI_PREFIX,
    column_name,
    format_uri,
    key_struct,
    parse_uri,
    table_name,
    uri_error,
)
from distributary.operators import badrows, parse, state
from distributary.operators import registry as schema_ops
from distributary.operators.atomic import choose_errors, shred_atomic, shred_atomic_json
from distributary.operators.entities import add_metadata, explode_entities
from distributary.operators.shred import INLINE_MODE, Registry, shred_joined
from distributary.plans.batches import committed
from distributary.plans.shredding import (
    BAD_ROWS,
    bad_records,
    event_rows,
    shred,
    table_rows,
)
from distributary.plans.tables import create_events_table, describe_table, list_tables, table_comments, widen_columns
from distributary.settings import configure, work_dir
from distributary.sources.lines import AT_TIMESTAMP, not_empty, start_from, stream_lines
from distributary.sources.records import RecordLog
from distributary.sources.registry import pick_by_priority, schemas_from
from distributary.streaming.discards import discard_reports
from distributary.streaming.load import Loader
from distributary.streaming.puts import BoundedPuts, committed_puts
from distributary.streaming.sinks import text_sink

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Position of two fields inside a line, to tell whose bad row it is.
TXN_ID, ETL_TSTAMP = 7, 2


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_enriched(enriched_lines(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred(enriched_lines(spark, sf_dir), registry(spark), SETTINGS)


def line_field(index: int) -> Column:
    return F.get(F.split("payload", "\t"), F.lit(index))


# Sources


@query
def scan_nonempty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    return not_empty(lines)


@query
def start_from_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return start_from(events, "ts", AT_TIMESTAMP, "2024-01-15 12:00:00")


@query
def decode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = "if(doc_id % 10 = 0, concat(encode(text, 'UTF-8'), unhex('80')), encode(text, 'UTF-8'))"
    documents = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{broken} as record")
    strict, encoded = decode_strict(F.col("record"))
    return documents.select(
        "doc_id",
        decode_payload(F.col("record")).alias("payload"),
        strict.alias("strict_payload"),
        encoded.alias("encoded"),
    )


@query
def undecodable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = "if(doc_id % 7 = 0, concat(encode(text, 'UTF-8'), unhex('FF')), encode(text, 'UTF-8'))"
    documents = table(spark, sf_dir, "documents").selectExpr(f"{broken} as record")
    enriched = badrows.undecodable(documents, "record", True)
    return enriched.unionByName(badrows.undecodable(documents, "record", False))


# Parsing


@query
def parse_enriched_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = (
        "event_id collector_tstamp etl_tstamp app_id txn_id v_etl user_id domain_sessionidx geo_country "
        "geo_latitude br_cookies event_name page_title page_url"
    ).split()
    good = parsed_lines(spark, sf_dir).where(F.size("errors") == 0)
    return good.select(*[F.col(f"atomic.{n}") for n in names])


@query
def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = parsed_lines(spark, sf_dir).select(F.explode("errors").alias("e"))
    return (
        errors.select("e.error", "e.field", "e.message")
        .groupBy("error", "field", "message")
        .agg(F.count("*").alias("n"))
    )


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Self-describing JSON lines of all events, some of them malformed."""
    uri = f"""concat('{URI_PREFIX}com.acme/props/jsonschema/1-0-', event_id % 3)"""
    line = f"""case event_id % 12
        when 0 then '{{"schema":'
        when 1 then concat('{{"schema":"', {uri}, '"}}')
        when 2 then concat('{{"schema":"com.acme/props/1-0-0","data":', props, '}}')
        when 3 then concat('{{"schema":"{URI_PREFIX}com.acme/props/jsonschema/1-0","data":', props, '}}')
        when 4 then concat('[', props, ']')
        when 5 then concat('{{"schema":"', {uri}, '","data":', props, '}} x')
        when 6 then concat('{{"schema":"', {uri}, '","data":{{"k":"many"}}}}')
        when 7 then concat('{{"schema":"{URI_PREFIX}com.acme/none/jsonschema/1-0-0","data":', props, '}}')
        when 8 then concat('{{"schema":"', {uri}, '","data":{{}}}}')
        else concat('{{"schema":"', {uri}, '","data":', props, '}}') end"""
    configure(spark)
    return spread(table(spark, sf_dir, "events")).selectExpr(f"{line} as value")


@query
def parse_self_describing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse(json_lines(spark, sf_dir), parse.SELF_DESCRIBING)
    entity = F.get("entities", F.lit(0))
    return parsed.select(
        "payload",
        entity["schema"].alias("schema"),
        plain_text(get_path(entity["data"], ["k"])).alias("k"),
        F.get("errors", F.lit(0))["error"].alias("error"),
    )


@query
def schema_uri_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    uris = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"""case event_id % 6
            when 0 then concat('{URI_PREFIX}com.acme-', user_id, '/', event_type, '/jsonschema/1-0-', event_id)
            when 1 then concat('{URI_PREFIX}org.w3/PageTiming/jsonschema/', user_id + 1, '-2-3')
            when 2 then concat('http://com.acme/', event_type, '/jsonschema/1-0-0')
            when 3 then concat('{URI_PREFIX}com.acme/', event_type, '/jsonschema/0-0-', user_id)
            when 4 then concat('{URI_PREFIX}com.acme/', event_type, '/1-0-0')
            else concat('{URI_PREFIX}com.acme/', event_type, '/jsonschema/1-0-3000000000') end as uri""",
    )
    keyed = uris.withColumn("key", parse_uri(F.col("uri")))
    return keyed.select(
        "event_id",
        "uri",
        "key.*",
        uri_error(F.col("uri")).alias("code"),
        format_uri(F.col("key")).alias("formatted"),
    )


# Shredding


@query
def entity_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_lines(spark, sf_dir).where(F.size("errors") == 0)
    parsed = parsed.select(F.col("atomic.event_id").alias("event_id"), "entities")
    return explode_entities(parsed, "event_id").select("event_id", "position", "schema")


@query
def entity_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_lines(spark, sf_dir).where(F.size("errors") == 0)
    parent = parsed.select("atomic.event_id", "atomic.collector_tstamp", "entities")
    exploded = explode_entities(parent, "event_id", "collector_tstamp")
    return add_metadata(exploded).drop("schema", "data")


@query
def atomic_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "event_id": uuid_of("doc_id"),
        "collector_tstamp": "'2024-01-01 00:00:00.000'",
        "v_collector": "'c'",
        "v_etl": "'e'",
        "page_title": "replace(text, '\\n', ' ')",
        "app_id": "source",
    }
    configure(spark)
    documents = lines_of(table(spark, sf_dir, "documents"), values)
    parsed = parse.parse_enriched(documents.selectExpr("array_join(fields, '\\t') as value"))
    rows = parsed.select(shred_atomic("atomic").alias("atomic"))
    return rows.select("atomic.event_id", "atomic.page_title", "atomic.app_id")


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON objects whose values have all kinds."""
    document = inputs.json_object(
        event_id=f"""case event_id % 7 when 0 then '12' when 1 then '"no-uuid"' when 2 then 'null'
            else {inputs.quoted(uuid_of("event_id"))} end""",
        collector_tstamp="""case event_id % 5 when 0 then 'true' when 1 then '"yesterday"'
            else concat('"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), '"') end""",
        txn_id="event_id",
        geo_latitude="value",
        br_cookies="event_id % 2 = 0",
        user_id="if(event_id % 3 = 0, '[1]', concat('\"u', user_id, '\"'))",
        page_title="concat('\"', repeat('ab ', cast(event_id % 600 as int)), '\"')",
    )
    configure(spark)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("number"), parse_document(F.expr(document)).alias("document")
    )


@query
def atomic_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    shredded = shred_atomic_json(event_documents(spark, sf_dir), "document", ATOMIC_SCHEMA)
    names = "event_id collector_tstamp txn_id geo_latitude br_cookies user_id page_title".split()
    return shredded.select(
        "number",
        *[F.col(f"atomic.{n}") for n in names],
        F.size("atomic_errors").alias("n_errors"),
        F.get("atomic_errors", F.lit(0))["message"].alias("first_expected"),
    )


@query
def error_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    shredded = shred_atomic_json(event_documents(spark, sf_dir), "document", ATOMIC_SCHEMA)
    failed = F.filter("atomic_errors", lambda e: F.col("number") % 2 == 0)
    chosen = choose_errors(failed, F.slice("atomic_errors", 1, 1))
    return shredded.select("number", F.size(chosen).alias("n_errors"))


@query
def json_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = """concat('{"a":{"b":[', event_id, ',{"c.d":"x', user_id, '"}],"e":null},"t":"1","o":', props, '}')"""
    events = table(spark, sf_dir, "events").select(
        "event_id", parse_document(F.expr(document)).alias("d")
    )
    paths = {
        "first": ["a", "b", 0],
        "dotted": ["a", "b", 1, "c.d"],
        "null_value": ["a", "e"],
        "text_value": ["t"],
        "object_value": ["o"],
        "missing": ["a", "b", "c"],
        "beyond": ["a", "b", 7],
    }
    found = [plain_text(get_path(F.col("d"), steps)).alias(n) for n, steps in paths.items()]
    return events.select("event_id", *found)


@query
def json_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", parse_document(F.to_json(F.struct("role", "text"))).alias("d")
    )
    return conversations.select(
        "conv_id",
        "turn",
        plain_text(get_path(F.col("d"), ["role"])).alias("role"),
        plain_text(get_path(F.col("d"), ["text"])).alias("text"),
    )


# Casts

MIXED_VALUES = f"""case event_id % 16
    when 0 then concat('{{"v":"text ', event_id, '"}}')
    when 1 then concat('{{"v":', event_id, '}}')
    when 2 then concat('{{"v":', event_id, '.5}}')
    when 3 then concat('{{"v":', event_id, '.0}}')
    when 4 then if(event_id % 32 = 4, '{{"v":true}}', '{{"v":false}}')
    when 5 then '{{"v":null}}'
    when 6 then '{{}}'
    when 7 then concat('{{"v":{{"k":', event_id, '}}}}')
    when 8 then concat('{{"v":[', event_id, ',"x"]}}')
    when 9 then concat('{{"v":"', upper({uuid_of("event_id")}), '"}}')
    when 10 then concat('{{"v":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), '"}}')
    when 11 then concat('{{"v":"', date_format(ts, "yyyy-MM-dd"), '"}}')
    when 12 then concat('{{"v":', event_id + 3000000000, '}}')
    when 13 then '{{"v":9223372036854775808}}'
    when 14 then '{{"v":1e3}}'
    else '{{"v":"abc"}}' end"""

CASTS = {
    "cast_uuid": ("UUID", None),
    "cast_varchar": ("VARCHAR", 64),
    "cast_boolean": ("BOOLEAN", None),
    "cast_char": ("CHAR", 3),
    "cast_integer": ("INTEGER", None),
    "cast_bigint": ("BIGINT", None),
    "cast_double": ("DOUBLE", None),
    "cast_jsonb": ("JSONB", None),
    "cast_date": ("DATE", None),
    "cast_timestamp": ("TIMESTAMP", None),
}


def cast_query(type_name: str, length: int | None, date_mode: str = "parse") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = table(spark, sf_dir, "events").selectExpr("event_id", f"{MIXED_VALUES} as text")
        documents = texts.select("event_id", parse_document(F.col("text")).alias("d"), marked(F.col("text")).alias("w"))
        written = written_at(F.col("w"), F.array(F.lit("v")))
        value, message = cast_json(get_path(F.col("d"), ["v"]), type_name, length, date_mode, written)
        return documents.select("event_id", value.alias("value"), message.alias("error"))

    return run


QUERIES |= {name: cast_query(*target) for name, target in CASTS.items()}
QUERIES["cast_date_reject"] = cast_query("DATE", None, "reject")


WRITTEN_VALUES = [
    "EID.0", "1e3", "-EID.10", '{"z": EID.50, "a": [1.0, {"y": -0, "b": "EID.0 \\"1e5"}], "k": null}',
    "12345678901234567890123456789012345678901", "9007199254740993e0", "EIDE+2", "-0", "25000e-3", "1.5e0", "9223372036854775807.0",
    "9223372036854775808.0", "[ EID.0 , 1E-7 ]", "1e400", '"EID.10"', "100000000000000000000000e-20",
]


@query
def values_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, lists and objects keep their text in VARCHAR and JSONB columns; whole numbers are exact however written."""
    configure(spark)
    branches = " ".join(f"when {i} then '{v}'" for i, v in enumerate(WRITTEN_VALUES)).replace("\\", "\\\\")
    token = f"replace(case event_id % {len(WRITTEN_VALUES)} {branches} end, 'EID', cast(event_id as string))"
    texts = table(spark, sf_dir, "events").selectExpr("event_id", f"""concat('{{"n":{{"v": ', {token}, ', "u":2}}}}') as text""")
    documents = texts.select("event_id", parse_document(F.col("text")).alias("d"), marked(F.col("text")).alias("w"))
    written = written_at(F.col("w"), F.array(F.lit("n"), F.lit("v")))
    value = get_path(F.col("d"), ["n", "v"])
    cast = lambda name, length=None: cast_json(value, name, length, written=written)
    return documents.select(
        "event_id",
        cast("VARCHAR", 64)[0].alias("as_varchar"),
        cast("JSONB")[0].alias("as_jsonb"),
        cast("BIGINT")[0].alias("as_bigint"),
        cast("INTEGER")[0].alias("as_integer"),
        cast("INTEGER")[1].alias("integer_error"),
    )


# Types, names and the registry

# One property definition per row of ``part``, by p_partkey % 30.
DEFINITIONS = [
    '{"type":"string","format":"date-time"}',
    '{"type":"string","format":"date"}',
    '{"type":"array"}',
    '{"type":"integer"}',
    '{"type":"integer","maximum":SIZE}',
    '{"type":"integer","maximum":1000000SIZE}',
    '{"type":"number"}',
    '{"type":"boolean"}',
    '{"type":"string","minLength":SIZE,"maxLength":SIZE}',
    '{"type":"string","format":"uuid"}',
    '{"type":"string","maxLength":SIZE}',
    '{"enum":["x","yy","NAME"]}',
    '{"enum":[1,SIZE]}',
    '{"type":"integer","enum":[1,SIZE]}',
    '{"enum":[SIZE,"y"]}',
    '{"enum":[true,false]}',
    '{"type":"number","multipleOf":5}',
    '{"type":["string","null"],"maxLength":SIZE}',
    '{"type":["string","integer"]}',
    '{"type":["integer","number"]}',
    '{"type":"string","format":"uuid","minLength":36,"maxLength":36}',
    "{}",
    '{"enum":["a",null]}',
    '{"type":"string"}',
    '{"type":"object"}',
    '{"enum":[1,3000000000]}',
    '{"type":"integer","enum":[1,3000000000]}',
    '{"type":"number","multipleOf":0.01}',
    '{"type":["boolean","null"]}',
    '{"type":["array","null"]}',
]


def part_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schema per part, with a required and an optional property of the same definition."""
    listed = ", ".join(f"'{d}'" for d in DEFINITIONS)
    definition = f"""replace(replace(element_at(array({listed}), cast(p_partkey % {len(DEFINITIONS)} as int) + 1),
        'SIZE', cast(p_size as string)), 'NAME', p_name)"""
    document = f"""concat('{{"self":{{"vendor":"com.parts","name":"part-', p_partkey,
        '","format":"jsonschema","version":"1-0-0"}},"type":"object","properties":{{"partSize":',
        {definition}, ',"extraSize":', {definition}, '}},"required":["partSize"]}}')"""
    configure(spark)
    documents = spread(table(spark, sf_dir, "part")).selectExpr(f"{document} as document")
    return schemas_from(documents)


def part_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_ops.column_table(part_schemas(spark, sf_dir))


@query
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_columns(spark, sf_dir).select("name", "column", "type", "length")


@query
def nullability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_columns(spark, sf_dir).select("name", "column", "nullable")


@query
def column_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_columns(spark, sf_dir).select("name", "column", "ddl")


@query
def column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pointer = """array(concat(event_type, 'Count'), concat('HTMLPart', user_id),
        concat('user-', event_type, 'ID'))"""
    events = table(spark, sf_dir, "events").selectExpr("event_id", f"{pointer} as pointer")
    return events.select("event_id", column_name(F.col("pointer")).alias("column"))


@query
def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = f"""concat('{URI_PREFIX}com.Acme-', user_id, '.labs/', initcap(event_type), 'PageView-x/jsonschema/',
        event_id % 4 + 1, '-0-0')"""
    events = table(spark, sf_dir, "events").selectExpr("event_id", f"{uri} as uri")
    return events.select("event_id", table_name(parse_uri(F.col("uri"))).alias("table_name"))


def order_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema keys from orders: 80 model groups with up to 180 versions each."""
    keys = table(spark, sf_dir, "orders").selectExpr(
        "concat('com.v', o_custkey % 40) as vendor",
        "'order' as name",
        "'jsonschema' as format",
        "cast(o_orderkey % 2 + 1 as int) as model",
        "cast(floor(o_orderkey / 2) % 12 as int) as revision",
        "cast(floor(o_orderkey / 24) % 15 as int) as addition",
    )
    return keys.distinct()


@query
def schema_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_ops.latest_schemas(order_schemas(spark, sf_dir))


@query
def schema_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = order_schemas(spark, sf_dir)
    known = keys.where("revision <= 6").groupBy("vendor", "name", "model").agg(
        F.max_by(key_struct(), F.struct("revision", "addition")).alias("known")
    )
    return schema_ops.schemas_until(keys, known.select("known.*")).select(*KEY_COLUMNS)


@query
def schema_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_ops.order_schemas(order_schemas(spark, sf_dir))


@query
def schema_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = order_schemas(spark, sf_dir)
    documents = """case revision % 3 when 0 then '{"type":"object"}' when 1 then '[1]' else '{"type":5}' end"""
    known = keys.where("addition < 10").selectExpr("*", f"{documents} as document")
    return schema_ops.fetch_schemas(keys, known)


@query
def registry_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    repositories = spark.createDataFrame(
        [("central", 0, ["org."]), ("mirror", 1, ["com.v1"]), ("local", 2, ["com.v2", "com.v3"])],
        "repository string, priority int, vendor_prefixes array<string>",
    )
    keys = order_schemas(spark, sf_dir)
    held = keys.withColumn("repository", F.explode(F.array(*map(F.lit, ("central", "mirror", "local")))))
    held = held.where("repository <> 'central' or addition % 2 = 0")
    documents = held.withColumn("document", F.concat_ws(":", "repository", "vendor"))
    return pick_by_priority(documents, repositories).select(*KEY_COLUMNS, "repository", "document")


def customer_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions per customer; ``nested`` gets properties later, ``c`` moves by customer."""
    k = "c_custkey"
    versions = f"""array(
        concat('{{"base":{{"type":"integer"}},"nested":{{"type":"object"}},"seg":{{"type":"string","maxLength":',
            10 + {k} % 5, '}}}}'),
        concat('{{"base":{{"type":"string"}},"nested":{{"type":"object","properties":{{"b":{{"type":"number"}}',
            if({k} % 2 = 0, ',"c":{{"type":"boolean"}}', ''), '}}}},"extraField":{{"type":"array"}}}}'),
        concat('{{"base":{{"type":"integer"}},"nested":{{"type":"object","properties":{{"b":{{"type":"number"}}',
            ',"c":{{"type":"boolean"}}', '}}}},"late":{{"type":"string","format":"date-time"}}}}'))"""
    configure(spark)
    rows = spread(table(spark, sf_dir, "customer")).selectExpr(k, f"posexplode({versions}) as (version, properties)")
    document = f"""concat('{{"self":{{"vendor":"com.customer","name":"c', {k},
        '","format":"jsonschema","version":"1-0-', version, '"}},"type":"object","required":["base","nested"],',
        '"properties":', properties, '}}')"""
    return schemas_from(rows.selectExpr(f"{document} as document"))


@query
def remove_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    united = schema_ops.union_properties(schema_ops.flatten_schemas(customer_schemas(spark, sf_dir)))
    kept = schema_ops.remove_roots(united)
    return kept.select("name", F.array_join("pointer", "/").alias("pointer"))


@query
def properties_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = schema_ops.column_table(customer_schemas(spark, sf_dir))
    return columns.select("name", "column", "ddl", F.col("addition").alias("first_seen"))


@query
def migration_added_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = customer_schemas(spark, sf_dir)
    known = versions.where("addition = cast(substring(name, 2, 20) as bigint) % 3").select(*KEY_COLUMNS)
    added = schema_ops.added_columns(schema_ops.column_table(versions), known)
    return added.select("name", "column", "type")


# State of the tables


def entity_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_lines(spark, sf_dir).where(F.size("errors") == 0)
    parsed = parsed.select(F.col("atomic.event_id").alias("event_id"), "entities")
    return explode_entities(parsed, "event_id").select("event_id", "key.*")


def known_state(spark: SparkSession) -> DataFrame:
    """Tables as they were before: props without its last version, no table of purchases."""
    return schemas(spark).where("addition < 2 and name <> 'purchase'").select(*KEY_COLUMNS)


@query
def table_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = state.table_state(entity_keys(spark, sf_dir), known_state(spark), ATOMIC_SCHEMA)
    return (
        checked.groupBy(format_uri(key_struct()).alias("uri"), "table_state").agg(F.count("*").alias("n"))
    )


@query
def event_state_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = state.table_state(entity_keys(spark, sf_dir), known_state(spark), ATOMIC_SCHEMA)
    events = state.event_state(checked, "event_id")
    return events.select(
        "event_id",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("outdated", ",").alias("outdated"),
        "ok",
    )


@query
def state_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = order_schemas(spark, sf_dir)
    before = keys.where("revision < 5")
    return state.put(before, keys.where("model = 2"))


def commented_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "if(c_custkey = 0, 'events', concat('t_', c_custkey)) as table_name",
        f"""case c_custkey % 4 when 0 then null when 1 then c_mktsegment
            when 2 then concat('{URI_PREFIX}com.customer/c', c_custkey, '/jsonschema/1-x')
            else concat('{URI_PREFIX}com.customer/c', c_custkey, '/jsonschema/1-0-1') end as comment""",
    )


@query
def comment_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = state.comment_issues(commented_tables(spark, sf_dir))
    return checked.where("issue is not null").select("table_name", "issue", "message")


@query
def state_from_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = customer_schemas(spark, sf_dir)
    return state.state_from_comments(commented_tables(spark, sf_dir), versions)


# Good and bad records


@query
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table_rows(records(spark, sf_dir), SETTINGS)
    return rows.groupBy("table_name").agg(F.count("*").alias("n"))


@query
def good_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "event_id txn_id collector_tstamp user_id geo_latitude br_cookies page_title".split()
    return event_rows(records(spark, sf_dir)).select(*names)


@query
def events_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values per column of the events table: all 128 of them are parsed and kept."""
    counts = [F.count(f.name).alias(f.name) for f in ATOMIC_FIELDS]
    counted = event_rows(records(spark, sf_dir)).agg(*counts)
    pairs = F.array(
        *[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("n")) for f in ATOMIC_FIELDS]
    )
    return counted.select(F.inline(pairs)).where("n > 0")


def typed_entities(rows: DataFrame, target: str, columns: dict[str, str]) -> DataFrame:
    cells = F.map_from_arrays("columns", "cells")
    typed = [F.try_element_at("c", F.lit(name)).cast(t).alias(name) for name, t in columns.items()]
    of_table = rows.where(F.col("table_name") == target)
    return of_table.select("root_id", cells.alias("c")).select("root_id", *typed)


@query
def entity_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table_rows(records(spark, sf_dir), SETTINGS).select(
        "table_name", "meta.root_id", "columns", "cells"
    )
    columns = {
        "user_id": "string",
        "active": "boolean",
        "address.city": "string",
        "address.zip_code": "bigint",
        "registered_at": "timestamp_ntz",
        "score": "double",
        "tags": "string",
    }
    typed = typed_entities(rows, "com_acme_user_profile_1", columns)
    return typed.toDF("root_id", *[c.replace(".", "_") for c in columns])


@query
def entity_cells_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same engine with the registry joined instead of sent along."""
    parsed = parsed_lines(spark, sf_dir).where(F.size("errors") == 0)
    large = Registry.from_schemas(registry(spark).schemas, folder=work_dir(spark))
    joined = shred_joined(parsed, large, True, ATOMIC_SCHEMA)
    flat = joined.select("atomic.event_id", F.inline("entities"))
    return flat.groupBy("table_name").agg(
        F.count("*").alias("n"),
        F.sum(F.size("errors")).cast("bigint").alias("n_errors"),
        F.count("violation").alias("n_violations"),
    )


@query
def bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = bad_records(records(spark, sf_dir))
    first = F.get("errors", F.lit(0))
    return bad.select(
        line_field(TXN_ID).alias("txn_id"),
        "kind",
        F.size("errors").alias("n_errors"),
        first["error"].alias("error"),
        first["field"].alias("field"),
        first["message"].alias("message"),
    )


@query
def bad_row_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table_rows(records(spark, sf_dir), SETTINGS).where("bad_row is not null")
    document = F.try_parse_json("bad_row")
    payload = F.split(plain_text(get_path(document, ["payload"])), "\t")
    return rows.select(
        F.get(payload, F.lit(TXN_ID)).alias("txn_id"),
        plain_text(get_path(document, ["kind"])).alias("kind"),
        plain_text(get_path(document, ["processor", "artifact"])).alias("artifact"),
        plain_text(get_path(document, ["failure", "errors", 0, "error"])).alias("error"),
    )


@query
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = bad_records(records(spark, sf_dir)).where(F.col("kind") == badrows.LOADER_RUNTIME_ERROR)
    message = F.get("errors", F.lit(0))["message"]
    return bad.select(line_field(TXN_ID).alias("txn_id"), message.alias("message"))


@query
def atomic_event_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = records(spark, sf_dir).groupBy(F.coalesce("failure.kind", F.lit("good")).alias("outcome"))
    return split.agg(F.count("*").alias("n"), F.sum(F.size("entities")).cast("bigint").alias("n_entities"))


@query
def self_describing_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    shredded = shred(json_lines(spark, sf_dir), registry(spark), JSON_SETTINGS)
    first = F.get("failure.errors", F.lit(0))
    return shredded.select(
        "payload",
        F.col("failure.kind").alias("kind"),
        first["error"].alias("error"),
        F.get("entities", F.lit(0))["table_name"].alias("table_name"),
    )


@query
def discard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = bad_records(records(spark, sf_dir)).select(
        line_field(ETL_TSTAMP).try_cast("timestamp_ntz").alias("ts")
    )
    return badrows.discard_counts(bad, "ts")


@query
def pii_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "user_ipaddress domain_userid network_userid refr_domain_userid domain_sessionid".split()
    return event_rows(records(spark, sf_dir)).select(*names)


@query
def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(records(spark, sf_dir)).select("event_id")


@query
def shred_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: rows per target table after shredding every event."""
    rows = table_rows(records(spark, sf_dir), SETTINGS).where(F.col("table_name") != BAD_ROWS)
    return rows.groupBy("table_name").agg(F.count("*").alias("n"))


# Tables and streams


def new_database(spark: SparkSession, name: str) -> str:
    """A database of its own for one run."""
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    location = f"{work_dir(spark)}/databases/{database}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    return database


def loaded(spark: SparkSession, sf_dir: str, name: str) -> str:
    database = new_database(spark, name)
    loader = Loader(spark, registry(spark), SETTINGS, database)
    loader.load(enriched_lines(spark, sf_dir))
    return database


def table_counts(spark: SparkSession, database: str) -> DataFrame:
    counts = [
        committed(spark, database, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in list_tables(spark, database)
    ]
    return reduce(DataFrame.unionAll, counts)


@query
def batch_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts(spark, loaded(spark, sf_dir, "batch_load"))


@query
def stream_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = new_database(spark, "stream_load")
    folder = f"{work_dir(spark)}/streams/{database}"
    enriched_lines(spark, sf_dir).write.text(f"{folder}/lines")
    lines = stream_lines(spark, f"{folder}/lines", max_files_per_trigger=4)
    loader = Loader(spark, registry(spark), SETTINGS, database)
    loader.stream(lines, f"{folder}/checkpoint", once=True).awaitTermination()
    return table_counts(spark, database)


@query
def loaded_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = loaded(spark, sf_dir, "table_rows")
    return committed(spark, database, "com_acme_props_1").select(
        "schema_vendor", "schema_name", "schema_format", "schema_version", "root_id", "root_tstamp", "k", "label", "ratio"
    )


@query
def loaded_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a created table in order, their declared types, and how many values each got."""
    database = loaded(spark, sf_dir, "columns")
    rows = committed(spark, database, "com_acme_props_1")
    counted = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in rows.columns])
    described = describe_table(spark, database, "com_acme_props_1")
    return described.join(counted.select(F.inline(pairs)), "column_name")


@query
def two_loads_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines loaded twice by one loader: each load counts."""
    database = new_database(spark, "two_loads")
    loader = Loader(spark, registry(spark), SETTINGS, database)
    for _ in range(2):
        loader.load(enriched_lines(spark, sf_dir))
    return table_counts(spark, database)


@query
def evolved_load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a version that the registry only lists once the load asks for it again."""
    database = new_database(spark, "evolved")
    listed = registry(spark).schemas
    old = Registry.from_schemas(listed.where("name <> 'props' or addition = 0"), mode=INLINE_MODE)
    loader = Loader(spark, old, SETTINGS, database, reload=lambda: registry(spark))
    loader.load(enriched_lines(spark, sf_dir))
    return committed(spark, database, "com_acme_props_1").select("schema_version", "root_id", "k", "label", "ratio")


@query
def collision_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two properties with one column name spoil the events of their group, no others."""
    twice = schema_document(
        "com.acme/props/jsonschema/1-0-3", {"k": {"type": "integer"}, "K": {"type": "integer"}}, ["k"]
    )
    types = "vendor string, name string, format string, model int, revision int, addition int, document string"
    extra = spark.createDataFrame([("com.acme", "props", "jsonschema", 1, 0, 3, twice[1])], types)
    spoiled = Registry.from_schemas(registry(spark).schemas.unionByName(extra), mode=INLINE_MODE)
    shredded = shred(enriched_lines(spark, sf_dir), spoiled, SETTINGS)
    collided = F.exists("failure.errors", lambda e: e["message"] == "column k has several properties")
    outcome = F.when(collided, "collision").otherwise(F.coalesce("failure.kind", F.lit("good")))
    return shredded.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The lines in two parts, by the number that most of them carry; a line is made before it is looked at, and once."""
    lines = settled(enriched_lines(spark, sf_dir))
    number = F.get(F.split("value", "\t"), F.lit(TXN_ID)).try_cast("long")
    first = F.coalesce(number % 2 == 0, F.lit(False))
    return lines.where(first), lines.where(~first)


@query
def replayed_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that stops between two tables is seen in none; its replay is seen once, and once more it changes nothing."""

    class Stopping(Loader):
        def fill(self, staged: DataFrame, table: str, batch_id: int, token: str) -> None:
            if table == "com_acme_props_1":
                raise InterruptedError(table)
            super().fill(staged, table, batch_id, token)

    database = new_database(spark, "replayed")
    first, second = halves(spark, sf_dir)
    Loader(spark, registry(spark), SETTINGS, database).load_batch(first, 0, "stream")
    before = table_counts(spark, database).withColumnRenamed("n", "n_before")
    try:
        Stopping(spark, registry(spark), SETTINGS, database, parallel_tables=1).load_batch(second, 1, "stream")
    except InterruptedError:
        pass
    stopped = spark.createDataFrame(table_counts(spark, database).collect(), "table_name string, n_stopped long")
    before = spark.createDataFrame(before.collect(), before.schema)
    for _ in range(2):
        Loader(spark, registry(spark), SETTINGS, database).load_batch(second, 1, "stream")
    return table_counts(spark, database).join(stopped, "table_name").join(before, "table_name", "left").na.fill(0, ["n_before"])


@query
def altered_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made for its first version, loaded, altered for later ones and loaded again; and its comment before and after."""
    database = new_database(spark, "altered")
    first, second = halves(spark, sf_dir)
    listed = registry(spark).schemas
    old = Registry.from_schemas(listed.where("name <> 'props' or addition = 0"), mode=INLINE_MODE)
    target = F.col("table_name") == "com_acme_props_1"

    def comment() -> str:
        return table_comments(spark, database).where(target).first().comment

    Loader(spark, old, SETTINGS, database).load(first)
    born = comment()
    n_columns = len(describe_table(spark, database, "com_acme_props_1").collect())
    Loader(spark, registry(spark), SETTINGS, database).load(second)
    rows = committed(spark, database, "com_acme_props_1").select("schema_version", "root_id", "k", "label", "ratio")
    return rows.select(
        "*", F.lit(n_columns).cast("long").alias("columns_before"), F.lit(born).alias("comment_before"), F.lit(comment()).alias("comment_after")
    )


@query
def widened_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column too narrow for most values refuses them; the same rows fit once it is wider, and its width is shown."""
    database = new_database(spark, "widen")
    create_events_table(spark, database)
    widen_columns(spark, database, EVENTS_TABLE, ["domain_sessionid"], "VARCHAR(36)")  # as it was born
    loader = Loader(spark, registry(spark), SETTINGS, database)
    lines = enriched_lines(spark, sf_dir)

    def width() -> str:
        described = describe_table(spark, database, EVENTS_TABLE).where("column_name = 'domain_sessionid'")
        return described.first().data_type

    before, refused = width(), False
    try:
        loader.load(lines)
    except Exception as fault:
        refused = "EXCEED_LIMIT_LENGTH" in str(fault) or "exceeds char/varchar type length" in str(fault)
        if not refused:
            raise
    widen_columns(spark, database, EVENTS_TABLE)
    loader.load(lines)
    rows = committed(spark, database, EVENTS_TABLE).select("event_id", "domain_sessionid", "geo_country")
    return rows.select("*", F.lit(before).alias("before"), F.lit(width()).alias("after"), F.lit(refused).alias("refused"))


@query
def existing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tables of the groups that events name are there after a load, and what they say of themselves."""
    database = loaded(spark, sf_dir, "existing")
    groups = entity_keys(spark, sf_dir).select(*GROUP_COLUMNS).distinct()
    names = sorted({r.table_name for r in groups.select(table_name(F.struct(*GROUP_COLUMNS)).alias("table_name")).collect()})
    present = [(name, spark.catalog.tableExists(f"{database}.{name}")) for name in names]
    rows = spark.createDataFrame(present, "table_name string, is_there boolean")
    there = rows.join(table_comments(spark, database), "table_name", "left")
    return there.select("table_name", "comment", "is_there")


@query
def bad_row_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows of two loads in files of JSON lines: appended, with their kind."""
    database = new_database(spark, "bad_files")
    path = f"{work_dir(spark)}/bad/{database}"
    for part in halves(spark, sf_dir):
        Loader(spark, registry(spark), SETTINGS, database, text_sink(path)).load(part)
    kind = F.get_json_object("value", "$.kind")
    return spark.read.text(path).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def record_log(spark: SparkSession, sf_dir: str) -> str:
    """The events as a record log: their times, and their lines' numbers as data."""
    path = f"{work_dir(spark)}/logs/{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp_ntz").alias("arrived"), F.encode(F.col("event_id").cast("string"), "UTF-8").alias("data"))
    events.repartitionByRange(6, "arrived").sortWithinPartitions("arrived").write.parquet(path)
    return path


def capped_stream(spark: SparkSession, log: str, folder: str, **options: str) -> DataFrame:
    """What a stream over the log delivers, stopped after some batches and started again: records by batch."""
    spark.dataSource.register(RecordLog)
    for limit in (3, None):
        stream = spark.readStream.format("record_log").options(path=log, positions=f"{folder}/positions", **options).load()
        seen: list[int] = []

        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
            seen.append(batch_id)  # noqa: B023

        query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").start()
        while limit is not None and len(seen) < limit and query.isActive and not query.exception():
            query.awaitTermination(0.05)
        if limit is None:
            query.processAllAvailable()
        query.stop()
        if query.exception():
            raise query.exception()
    return spark.read.parquet(f"{folder}/out").select("arrived", F.decode("data", "UTF-8").cast("long").alias("event_id"), "batch")


@query
def capped_record_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log in batches of a twentieth at most, over a restart: each record once, no batch beyond the cap."""
    log = record_log(spark, sf_dir)
    cap = -(-spark.read.parquet(log).count() // 20)
    got = capped_stream(spark, log, f"{work_dir(spark)}/streams/{uuid.uuid4().hex}", max_records=str(cap))
    sizes = got.groupBy("batch").agg(F.count("*").alias("size"))
    largest = sizes.agg(F.max("size").alias("largest"), F.count("*").alias("batches")).first()
    return got.groupBy("event_id").agg(F.count("*").alias("times")).select(
        "event_id", "times", F.lit(largest.largest <= cap).alias("within_cap"), F.lit(largest.batches >= 20).alias("many_batches")
    )


@query
def records_since_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the log that arrived at the middle of its time or later, as a stream from there on."""
    log = record_log(spark, sf_dir)
    bounds = spark.read.parquet(log).agg(F.min("arrived").alias("a"), F.max("arrived").alias("b")).first()
    since = bounds.a + (bounds.b - bounds.a) / 2
    options = {"position": AT_TIMESTAMP, "timestamp": since.isoformat(), "max_records": "100000"}
    folder = f"{work_dir(spark)}/streams/{uuid.uuid4().hex}"
    spark.dataSource.register(RecordLog)
    stream = spark.readStream.format("record_log").options(path=log, positions=f"{folder}/positions", **options).load()
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    running = writer.start()
    running.processAllAvailable()
    running.stop()
    return spark.read.parquet(f"{folder}/out").select("arrived", F.decode("data", "UTF-8").cast("long").alias("event_id"))


@query
def bounded_puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows of a stream in puts of at most 500 items and 200,000 bytes: every line once, no larger put."""
    folder = f"{work_dir(spark)}/streams/{uuid.uuid4().hex}"
    enriched_lines(spark, sf_dir).write.text(f"{folder}/lines")
    spark.dataSource.register(BoundedPuts)
    lines = stream_lines(spark, f"{folder}/lines", max_files_per_trigger=3)
    bad = bad_records(shred(lines, registry(spark), SETTINGS)).select(F.col("payload").alias("value"))
    sink = bad.writeStream.format("bounded_puts").options(path=f"{folder}/sink", max_items="500", max_bytes="200000")
    sink.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    items = committed_puts(spark, f"{folder}/sink")
    by_put = items.groupBy("file", "put").agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("size"))
    largest = by_put.agg(F.max("n").alias("n"), F.max(F.when(F.col("n") > 1, F.col("size"))).alias("size")).first()
    bounded = largest.n <= 500 and (largest.size or 0) <= 200_000
    txn = F.get(F.split("value", "\t"), F.lit(TXN_ID)).try_cast("long").alias("txn_id")
    return items.groupBy(txn).agg(F.count("*").alias("times")).withColumn("bounded", F.lit(bounded))


@query
def stream_discard_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows of a stream that drops them, counted in its state: stopped after a batch, started again, ended when all is reported."""
    folder = f"{work_dir(spark)}/streams/{uuid.uuid4().hex}"
    bad = bad_records(shred(enriched_lines(spark, sf_dir), registry(spark), SETTINGS)).select("payload")
    bad.write.parquet(f"{folder}/all")
    written = spark.read.schema(bad.schema).parquet(f"{folder}/all")
    later = F.pmod(F.xxhash64("payload"), F.lit(2)) == 1
    written.filter(~later).write.parquet(f"{folder}/bad")
    arriving = spark.readStream.schema(bad.schema).option("maxFilesPerTrigger", 3).parquet(f"{folder}/bad")
    reports = discard_reports(arriving, period_seconds=3)
    for restarted in (False, True):
        if restarted:  # without new rows Spark runs no batch, and so no timer of what is pending
            written.filter(later).write.mode("append").parquet(f"{folder}/bad")
        writer = reports.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
        running = writer.trigger(processingTime="500 milliseconds").start()
        try:
            while running.isActive:  # timers keep the stream busy, so it ends when a batch finds neither rows nor counts
                progress = running.lastProgress
                counts = progress["stateOperators"] if progress else []
                if counts and (not restarted or progress["numInputRows"] == counts[0]["numRowsTotal"] == 0):
                    break
                running.awaitTermination(0.2)
        finally:
            running.stop()
        if running.exception():
            raise running.exception()
    found = spark.read.schema(reports.schema).parquet(f"{folder}/out")
    return found.agg(
        F.coalesce(F.sum("discarded"), F.lit(0)).alias("discarded"),
        F.coalesce(F.bool_or(F.col("discarded") <= 0), F.lit(False)).alias("any_empty"),
        (F.count("*") > 0).alias("any_report"),
    )
