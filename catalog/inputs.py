"""Inputs of the registered queries, derived by Spark from the given tables.

Every event becomes one enriched line. ``event_id % 50`` picks a fault or a special case, so that each
branch of the engine is met at any scale; see ``CASES``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from distributary.functions.event_layout import LINE_FIELDS
from distributary.functions.schema_uri import KEY_COLUMNS, URI_PREFIX
from distributary.operators.shred import INLINE_MODE, Registry
from distributary.settings import Settings, configure

ATOMIC_SCHEMA = f"{URI_PREFIX}com.acme/atomic/jsonschema/1-0-0"
SETTINGS = Settings(atomic_schema=ATOMIC_SCHEMA)
JSON_SETTINGS = Settings(atomic_schema=ATOMIC_SCHEMA, purpose="JSON")

CASES = {
    0: "malformed event_id",
    1: "130 fields",
    2: "empty v_etl",
    3: "geo_country of 3 characters",
    4: "br_name of 60 characters",
    5: "entity with an unknown schema",
    6: "property of the wrong kind",
    7: "two properties of the wrong kind in one entity",
    8: "property of the wrong kind and malformed time",
    9: "contexts are no JSON",
    10: "no tabs",
    11: "malformed boolean",
    12: "malformed integer",
    13: "malformed double",
    14: "malformed collector_tstamp",
    15: "malformed boolean and integer",
    16: "page_title of 1500 characters (good)",
    17: "page_url of 2000 characters (good)",
    18: "property longer than its column",
    19: "required property missing",
    20: "malformed uuid in an entity",
    21: "same entity twice (good)",
    22: "null property (good)",
    23: "integer written as 5.0 (good)",
    24: "text after the JSON document",
}
PARSING_CASES = [0, 1, 2, 8, 9, 10, 11, 12, 13, 14, 15, 24]
SCHEMA_CASES = [5, 6, 7, 20]
RUNTIME_CASES = [3, 4, 18, 19]
EMPTY = "''"
BAD_CASES = sorted(PARSING_CASES + SCHEMA_CASES + RUNTIME_CASES)


def schema_document(uri: str, properties: dict, required: list[str]) -> tuple[str, str]:
    vendor, name, form, version = uri.split("/")
    about = {"vendor": vendor, "name": name, "format": form, "version": version}
    body = {"self": about, "type": "object", "properties": properties, "required": required}
    return uri, json.dumps(body)


def text(length: int) -> dict:
    return {"type": "string", "maxLength": length}


K = {"k": {"type": "integer"}}
LABEL = {"label": text(20)}
EVENT_PROPERTIES = {"value": {"type": "number"}, "amountCents": {"type": "integer", "maximum": 2000000000}}
REGISTRY_DOCUMENTS = [
    schema_document("com.acme/props/jsonschema/1-0-0", K, ["k"]),
    schema_document("com.acme/props/jsonschema/1-0-1", K | LABEL, ["k"]),
    schema_document("com.acme/props/jsonschema/1-0-2", K | LABEL | {"ratio": {"type": "number"}}, ["k"]),
    schema_document(
        "com.acme/user_profile/jsonschema/1-0-0",
        {
            "userId": text(64),
            "score": {"type": ["number", "null"]},
            "active": {"type": "boolean"},
            "registeredAt": {"type": "string", "format": "date-time"},
            "address": {
                "type": "object",
                "properties": {"city": text(40), "zipCode": {"type": "integer"}},
            },
            "tags": {"type": "array"},
        },
        ["userId"],
    ),
    schema_document(
        "org.acme-labs/DeviceInfo/jsonschema/2-0-1",
        {
            "deviceId": {"type": "string", "format": "uuid"},
            "osVersion": {"type": ["string", "null"], "maxLength": 16},
            "releaseDate": {"type": "string", "format": "date"},
        },
        ["deviceId"],
    ),
    *[
        schema_document(f"com.acme/{name}/jsonschema/1-0-0", EVENT_PROPERTIES, ["value"])
        for name in ("click", "error", "purchase", "signup", "view")
    ],
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schemas(spark: SparkSession) -> DataFrame:
    """The registry behind the event queries."""
    rows = []
    for uri, document in REGISTRY_DOCUMENTS:
        vendor, name, form, version = uri.split("/")
        rows.append((vendor, name, form, *map(int, version.split("-")), document))
    types = "string string string int int int string".split()
    names = [*KEY_COLUMNS, "document"]
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, types)))


_registries: dict[int, Registry] = {}


def registry(spark: SparkSession) -> Registry:
    """Registry of the event queries, prepared once per session."""
    key = id(spark.sparkContext)
    if key not in _registries:
        _registries[key] = Registry.from_schemas(schemas(configure(spark)), mode=INLINE_MODE)
    return _registries[key]


def uuid_of(value: str) -> str:
    """SQL of a UUID made from a value."""
    groups = "(.{8})(.{4})(.{4})(.{4})(.{12})"
    return f"regexp_replace(md5(cast({value} as string)), '{groups}', '$1-$2-$3-$4-$5')"


def choose(default: str, cases: dict[int | tuple[int, ...], str]) -> str:
    """SQL of a text that differs in some cases."""
    branches = []
    for numbers, value in cases.items():
        numbers = numbers if isinstance(numbers, tuple) else (numbers,)
        branches.append(f"when event_id % 50 in ({', '.join(map(str, numbers))}) then {value}")
    return f"case {' '.join(branches)} else cast({default} as string) end"


def json_object(**fields: str) -> str:
    """SQL of a JSON object, from the SQL of its fields' JSON texts."""
    parts = []
    for i, (name, value) in enumerate(fields.items()):
        parts += [f"""'{"," if i else "{"}"{name}":'""", f"cast({value} as string)"]
    return f"concat({', '.join(parts)}, '}}')"


def quoted(value: str) -> str:
    """SQL of a JSON string, from the SQL of its parts."""
    return f"""concat('"', {value}, '"')"""


def entity(uri: str, data: str) -> str:
    return json_object(schema=quoted(f"concat('{URI_PREFIX}', {uri})"), data=data)


def props_entity() -> str:
    k = "get_json_object(props, '$.k')"
    k = choose(k, {(6, 8): quoted("'many'"), 23: f"concat({k}, '.0')"})
    label = quoted(choose("concat('label ', user_id)", {18: "repeat('x', 30)"}))
    data = f"""case when event_id % 50 = 19 then '{{}}'
        when event_id % 3 = 1 or event_id % 50 = 18 then {json_object(k=k, label=label)}
        when event_id % 3 = 2 then {json_object(k=k, label=label, ratio="value")}
        else {json_object(k=k)} end"""
    return entity("'com.acme/props/jsonschema/1-0-', event_id % 3", data)


def user_entity() -> str:
    data = json_object(
        userId=quoted("'u', user_id"),
        score=choose("value", {7: quoted("'high'")}),
        active=choose("event_id % 2 = 0", {7: "'1'"}),
        registeredAt=quoted("""date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")"""),
        address=json_object(city=quoted("'city ', user_id % 7"), zipCode="user_id + 10000"),
        tags="""concat('["a",', user_id, ',{"b":null}]')""",
    )
    return entity("'com.acme/user_profile/jsonschema/1-0-0'", data)


def device_entity() -> str:
    data = json_object(
        deviceId=quoted(choose(f"upper({uuid_of('user_id')})", {20: "'no-uuid'"})),
        osVersion=choose(quoted("'14.1'"), {22: "'null'"}),
        releaseDate=quoted("date_format(ts, 'yyyy-MM-dd')"),
    )
    return entity("'org.acme-labs/DeviceInfo/jsonschema/2-0-1'", data)


def envelope(name: str, data: str) -> str:
    return entity(f"'com.acme/{name}/jsonschema/1-0-0'", data)


def contexts() -> str:
    unknown = entity("'com.acme/unknown/jsonschema/1-0-0'", "'{}'")
    listed = f"""concat_ws(',', {props_entity()},
        if(event_id % 50 = 21, {props_entity()}, null),
        if(event_id % 50 = 5, {unknown}, null),
        if(user_id % 3 = 0 or event_id % 50 = 7, {user_entity()}, null))"""
    text = envelope("contexts", f"concat('[', {listed}, ']')")
    return choose(text, {9: """'{"schema":'""", 24: f"concat({text}, ' x')"})


def event_fields() -> dict[str, str]:
    clock = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS')"
    bad_clock = "'2024-13-01 00:00:00.000'"
    unstruct = entity(
        "'com.acme/', event_type, '/jsonschema/1-0-0'",
        json_object(value="value", amountCents="cast(round(value * 100) as int)"),
    )
    return {
        "app_id": "concat('app', event_id % 5)",
        "platform": "'web'",
        "etl_tstamp": clock,
        "collector_tstamp": choose(clock, {14: bad_clock}),
        "dvce_created_tstamp": choose("''", {8: bad_clock}),
        "event": "'unstruct'",
        "event_id": choose(uuid_of("event_id"), {0: "'no-uuid'"}),
        "txn_id": "event_id",
        "v_collector": "'collector-1'",
        "v_etl": choose("'etl-1'", {2: "''"}),
        "user_id": "concat('u', user_id)",
        "user_ipaddress": "repeat(md5(concat('i', user_id)), 4)",
        "domain_userid": "repeat(md5(concat('d', user_id)), 4)",
        "domain_sessionidx": choose("event_id % 9", {(12, 15): "'x1'"}),
        "network_userid": "repeat(md5(concat('n', user_id)), 4)",
        "geo_country": choose("'DE'", {3: "'USA'"}),
        "geo_latitude": choose("value", {13: "'north'"}),
        "page_url": choose(
            "concat('https://a.example/', user_id)",
            {17: "concat('https://a.example/', repeat('p', 1982))"},
        ),
        "page_title": choose("event_type", {16: "repeat('title ', 250)"}),
        "contexts": contexts(),
        "unstruct_event": envelope("unstruct_event", unstruct),
        "br_name": choose("'Browser'", {4: "repeat('b', 60)"}),
        "br_cookies": choose("event_id % 2", {(11, 15): "'2'"}),
        "derived_contexts": envelope("contexts", f"concat('[', {device_entity()}, ']')"),
        "refr_domain_userid": "repeat(md5(concat('r', user_id)), 4)",
        "domain_sessionid": "repeat(md5(concat('s', user_id)), 4)",
        "event_name": "event_type",
    }


def spread(frame: DataFrame) -> DataFrame:
    """Use all cores where a small file gives fewer partitions; large inputs are left as they are."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


def lines_of(frame: DataFrame, values: dict[str, str]) -> DataFrame:
    """Add the array ``fields`` of an enriched line, from the SQL of those that are not empty."""
    fields = ", ".join(f"cast({values.get(f.name, EMPTY)} as string)" for f in LINE_FIELDS)
    return spread(frame).selectExpr("*", f"array({fields}) as fields")


def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tab-separated line per event, in ``value``."""
    configure(spark)
    line = choose(
        "array_join(fields, '\t')",
        {10: "'no tabs here'", 1: "array_join(slice(fields, 1, 130), '\t')"},
    )
    return lines_of(table(spark, sf_dir, "events"), event_fields()).selectExpr(f"{line} as value")
