"""The same results as SQL over the given tables."""

from __future__ import annotations

from catalog.inputs import BAD_CASES, PARSING_CASES, RUNTIME_CASES, SCHEMA_CASES
from distributary.functions.schema_uri import URI_PREFIX
from distributary.settings import NAME


def listed(cases: list[int]) -> str:
    return ", ".join(map(str, cases))


def uuid_of(value: str) -> str:
    groups = "(.{8})(.{4})(.{4})(.{4})(.{12})"
    return rf"regexp_replace(md5(cast({value} as varchar)), '{groups}', '\1-\2-\3-\4-\5')"


CASE = "event_id % 50"
GOOD = f"{CASE} not in ({listed(BAD_CASES)})"
PARSED = f"{CASE} not in ({listed(PARSING_CASES)})"
BAD = f"{CASE} in ({listed(BAD_CASES)})"
EVENT_UUID = uuid_of("event_id")
CLOCK = "date_trunc('milliseconds', ts)"
TITLE = f"case when {CASE} = 16 then substr(repeat('title ', 250), 1, 1024) else event_type end"
PAGE_URL = (
    f"case when {CASE} = 17 then 'https://a.example/' || repeat('p', 1982) "
    "else 'https://a.example/' || user_id end"
)

ORACLES: dict[str, str] = {}

ORACLES["scan_nonempty_lines"] = """
select doc_id, value from (select doc_id, unnest(string_split(text, chr(10))) as value from documents)
where length(value) > 0"""

ORACLES["start_from_timestamp"] = """
select event_id, ts from events where ts >= timestamp '2024-01-15 12:00:00'"""

ORACLES["decode_payloads"] = r"""
select doc_id,
  case when doc_id % 10 = 0 then text || chr(65533) else text end as payload,
  case when doc_id % 10 <> 0 then text end as strict_payload,
  case when doc_id % 10 = 0 then base64(encode(text) || '\x80'::blob) end as encoded
from documents"""

ORACLES["undecodable_records"] = r"""
select kind, 'Cannot deserialize payload as UTF-8' as message, base64(encode(text) || '\xFF'::blob) as payload
from documents, (values ('loader_parsing_error'), ('generic_error')) k(kind) where doc_id % 7 = 0"""

ORACLES["parse_enriched_tsv"] = f"""
select {EVENT_UUID} as event_id, {CLOCK} as collector_tstamp, {CLOCK} as etl_tstamp,
  'app' || (event_id % 5) as app_id, cast(event_id as integer) as txn_id, 'etl-1' as v_etl,
  'u' || user_id as user_id, cast(event_id % 9 as integer) as domain_sessionidx,
  case when {CASE} = 3 then 'USA' else 'DE' end as geo_country, value as geo_latitude,
  event_id % 2 = 1 as br_cookies, event_type as event_name,
  case when {CASE} = 16 then repeat('title ', 250) else event_type end as page_title,
  {PAGE_URL} as page_url
from events where {PARSED}"""

ORACLES["parse_errors"] = f"""
with faults(number, error, field, message) as (values
  (0, 'InvalidValue', 'event_id', 'Cannot parse event_id as UUID'),
  (1, 'FieldNumberMismatch', null, 'Expected 131 fields, found 130'),
  (2, 'InvalidValue', 'v_etl', 'Field v_etl cannot be empty'),
  (8, 'InvalidValue', 'dvce_created_tstamp', 'Cannot parse dvce_created_tstamp as TIMESTAMP'),
  (9, 'InvalidValue', 'contexts', 'Cannot parse contexts as JSON'),
  (10, 'NotTSV', null, 'Line is not tab-separated'),
  (11, 'InvalidValue', 'br_cookies', 'Cannot parse br_cookies as BOOLEAN'),
  (12, 'InvalidValue', 'domain_sessionidx', 'Cannot parse domain_sessionidx as INTEGER'),
  (13, 'InvalidValue', 'geo_latitude', 'Cannot parse geo_latitude as DOUBLE'),
  (14, 'InvalidValue', 'collector_tstamp', 'Cannot parse collector_tstamp as TIMESTAMP'),
  (15, 'InvalidValue', 'br_cookies', 'Cannot parse br_cookies as BOOLEAN'),
  (15, 'InvalidValue', 'domain_sessionidx', 'Cannot parse domain_sessionidx as INTEGER'),
  (24, 'InvalidValue', 'contexts', 'Cannot parse contexts as JSON'))
select error, field, message, count(*) as n from events join faults on {CASE} = number
group by error, field, message"""

PROPS_URI = f"'{URI_PREFIX}com.acme/props/jsonschema/1-0-' || (event_id % 3)"
JSON_LINE = f"""case event_id % 12
  when 0 then '{{"schema":'
  when 1 then '{{"schema":"' || {PROPS_URI} || '"}}'
  when 2 then '{{"schema":"com.acme/props/1-0-0","data":' || props || '}}'
  when 3 then '{{"schema":"{URI_PREFIX}com.acme/props/jsonschema/1-0","data":' || props || '}}'
  when 4 then '[' || props || ']'
  when 5 then '{{"schema":"' || {PROPS_URI} || '","data":' || props || '}} x'
  when 6 then '{{"schema":"' || {PROPS_URI} || '","data":{{"k":"many"}}}}'
  when 7 then '{{"schema":"{URI_PREFIX}com.acme/none/jsonschema/1-0-0","data":' || props || '}}'
  when 8 then '{{"schema":"' || {PROPS_URI} || '","data":{{}}}}'
  else '{{"schema":"' || {PROPS_URI} || '","data":' || props || '}}' end"""
JSON_ERROR = """case event_id % 12 when 0 then 'ParsingFailure' when 1 then 'INVALID_DATA_PAYLOAD'
  when 2 then 'INVALID_IGLUURI' when 3 then 'INVALID_SCHEMAVER' when 4 then 'INVALID_DATA_PAYLOAD'
  when 5 then 'ParsingFailure' end"""

ORACLES["parse_self_describing"] = f"""
select {JSON_LINE} as payload,
  case when event_id % 12 = 7 then '{URI_PREFIX}com.acme/none/jsonschema/1-0-0'
    when event_id % 12 > 5 then {PROPS_URI} end as schema,
  case when event_id % 12 = 6 then 'many' when event_id % 12 = 7 or event_id % 12 > 8
    then json_extract_string(props, '$.k') end as k,
  {JSON_ERROR} as error
from events"""

ORACLES["self_describing_load"] = f"""
select {JSON_LINE} as payload,
  case when event_id % 12 < 9 then 'generic_error' end as kind,
  case event_id % 12 when 6 then 'WrongType' when 7 then 'SchemaListNotFound' when 8 then 'RuntimeError'
    else {JSON_ERROR} end as error,
  case when event_id % 12 in (6, 8, 9, 10, 11) then 'com_acme_props_1' end as table_name
from events"""

ORACLES["schema_uri_parse"] = f"""
with uris as (select event_id, case event_id % 6
    when 0 then '{URI_PREFIX}com.acme-' || user_id || '/' || event_type || '/jsonschema/1-0-' || event_id
    when 1 then '{URI_PREFIX}org.w3/PageTiming/jsonschema/' || (user_id + 1) || '-2-3'
    when 2 then 'http://com.acme/' || event_type || '/jsonschema/1-0-0'
    when 3 then '{URI_PREFIX}com.acme/' || event_type || '/jsonschema/0-0-' || user_id
    when 4 then '{URI_PREFIX}com.acme/' || event_type || '/1-0-0'
    else '{URI_PREFIX}com.acme/' || event_type || '/jsonschema/1-0-3000000000' end as uri,
  user_id, event_type from events)
select event_id, uri,
  case event_id % 6 when 0 then 'com.acme-' || user_id when 1 then 'org.w3' end as vendor,
  case event_id % 6 when 0 then event_type when 1 then 'PageTiming' end as name,
  case when event_id % 6 < 2 then 'jsonschema' end as format,
  cast(case event_id % 6 when 0 then 1 when 1 then user_id + 1 end as integer) as model,
  cast(case event_id % 6 when 0 then 0 when 1 then 2 end as integer) as revision,
  cast(case event_id % 6 when 0 then event_id when 1 then 3 end as integer) as addition,
  case event_id % 6 when 2 then 'INVALID_IGLUURI' when 4 then 'INVALID_IGLUURI'
    when 3 then 'INVALID_SCHEMAVER' when 5 then 'INVALID_SCHEMAVER' end as code,
  case when event_id % 6 < 2 then uri end as formatted
from uris"""

ENTITIES = f"""
select event_id, user_id, value, ts, props, event_type, {EVENT_UUID} as uuid,
  unnest(schemas) as schema, generate_subscripts(schemas, 1) - 1 as position
from (select *, list_filter([
    'com.acme/props/jsonschema/1-0-' || (event_id % 3),
    case when {CASE} = 21 then 'com.acme/props/jsonschema/1-0-' || (event_id % 3) end,
    case when {CASE} = 5 then 'com.acme/unknown/jsonschema/1-0-0' end,
    case when user_id % 3 = 0 or {CASE} = 7 then 'com.acme/user_profile/jsonschema/1-0-0' end,
    'org.acme-labs/DeviceInfo/jsonschema/2-0-1',
    'com.acme/' || event_type || '/jsonschema/1-0-0'], lambda s: s is not null) as schemas
  from events)"""

ORACLES["entity_list"] = f"""
select uuid as event_id, cast(position as integer) as position, '{URI_PREFIX}' || schema as schema
from ({ENTITIES}) where {PARSED}"""

ORACLES["entity_metadata"] = f"""
select split_part(schema, '/', 1) as schema_vendor, split_part(schema, '/', 2) as schema_name,
  split_part(schema, '/', 3) as schema_format, split_part(schema, '/', 4) as schema_version,
  uuid as root_id, {CLOCK} as root_tstamp, cast(position as integer) as position
from ({ENTITIES}) where {PARSED}"""

ORACLES["atomic_truncate"] = f"""
select {uuid_of("doc_id")} as event_id, substr(replace(text, chr(10), ' '), 1, 1024) as page_title,
  source as app_id
from documents"""

ORACLES["atomic_json"] = f"""
select event_id as number,
  case when event_id % 7 > 2 then {EVENT_UUID} end as event_id,
  case when event_id % 5 > 1 then {CLOCK} end as collector_tstamp,
  cast(event_id as integer) as txn_id, value as geo_latitude, event_id % 2 = 0 as br_cookies,
  case when event_id % 3 <> 0 then 'u' || user_id end as user_id,
  substr(repeat('ab ', event_id % 600), 1, 1024) as page_title,
  cast((event_id % 7 < 2)::int + (event_id % 5 < 2)::int as integer) as n_errors,
  case when event_id % 5 < 2 then 'date-time' when event_id % 7 < 2 then 'uuid' end as first_expected
from events"""

ORACLES["error_precedence"] = """
select event_id as number,
  cast(case when event_id % 2 = 0 then (event_id % 7 < 2)::int + (event_id % 5 < 2)::int
    else ((event_id % 7 < 2) or (event_id % 5 < 2))::int end as integer) as n_errors
from events"""

ORACLES["json_pointer"] = """
select event_id, cast(event_id as varchar) as first, 'x' || user_id as dotted,
  cast(null as varchar) as null_value, '1' as text_value, replace(props, ' ', '') as object_value,
  cast(null as varchar) as missing, cast(null as varchar) as beyond
from events"""

ORACLES["json_text_roundtrip"] = "select conv_id, turn, role, text from conversations"

# Casts: JSON text of the value by event_id % 16, as it stands in messages.
TOKEN = f"""case event_id % 16 when 0 then '"text ' || event_id || '"' when 1 then '' || event_id
  when 2 then event_id || '.5' when 3 then event_id || '.0'
  when 4 then case when event_id % 32 = 4 then 'true' else 'false' end
  when 7 then '{{"k":' || event_id || '}}' when 8 then '[' || event_id || ',"x"]'
  when 9 then '"' || upper({EVENT_UUID}) || '"'
  when 10 then '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"'
  when 11 then '"' || strftime(ts, '%Y-%m-%d') || '"' when 12 then '' || (event_id + 3000000000)
  when 13 then '9223372036854775808' when 14 then '1e3' when 15 then '"abc"' end"""


def cast_sql(ddl: str, value: str, type_name: str, error: str | None = None) -> str:
    message = error or f"'Invalid type {ddl} for value ' || token"
    return f"""
select event_id, cast(value as {type_name}) as value,
  case when token is not null and value is null then {message} end as error
from (select event_id, ts, {TOKEN} as token, {value} as value from events)"""


def by_case(**values: str) -> str:
    branches = " ".join(f"when {number[1:]} then {value}" for number, value in values.items())
    return f"case event_id % 16 {branches} end"


INT_VALUES = {"_1": "event_id", "_3": "event_id", "_14": "1000"}
TEXT = f"""case when event_id % 16 in (0, 9, 10, 11, 15) then substr({TOKEN}, 2, length({TOKEN}) - 2)
  else {TOKEN} end"""
UNPARSED = """case when event_id % 16 in (0, 9, 11, 15)
    then 'Text ''' || substr(token, 2, length(token) - 2) || ''' could not be parsed'
    else 'Invalid type TIMESTAMP for value ' || token end"""
ORACLES |= {
    "cast_uuid": cast_sql("UUID", by_case(_9=EVENT_UUID), "varchar"),
    "cast_varchar": cast_sql("VARCHAR(64)", TEXT, "varchar"),
    "cast_boolean": cast_sql("BOOLEAN", by_case(_4="event_id % 32 = 4"), "boolean"),
    "cast_char": cast_sql("CHAR(3)", by_case(_15="'abc'"), "varchar"),
    "cast_integer": cast_sql("INTEGER", by_case(**INT_VALUES), "integer"),
    "cast_bigint": cast_sql("BIGINT", by_case(**INT_VALUES, _12="event_id + 3000000000"), "bigint"),
    "cast_double": cast_sql(
        "DOUBLE PRECISION",
        by_case(
            _1="event_id::double",
            _2="event_id + 0.5::double",
            _3="event_id::double",
            _12="(event_id + 3000000000)::double",
            _13="9223372036854775808::double",
            _14="1000::double",
        ),
        "double",
    ),
    "cast_jsonb": cast_sql("JSONB", TOKEN, "varchar"),
    "cast_date": cast_sql("DATE", by_case(_11="ts::date"), "date"),
    "cast_date_reject": cast_sql("DATE", "null", "date"),
    "cast_timestamp": cast_sql("TIMESTAMP", by_case(_10=CLOCK), "timestamp", UNPARSED),
}

WRITTEN = """case event_id % 16 when 0 then event_id || '.0' when 1 then '1e3' when 2 then '-' || event_id || '.10'
  when 3 then '{"z":' || event_id || '.50,"a":[1.0,{"y":-0,"b":"' || event_id || '.0 \\"1e5"}],"k":null}'
  when 4 then '12345678901234567890123456789012345678901' when 5 then '9007199254740993e0'
  when 6 then event_id || 'E+2' when 7 then '-0' when 8 then '25000e-3' when 9 then '1.5e0'
  when 10 then '9223372036854775807.0' when 11 then '9223372036854775808.0'
  when 12 then '[' || event_id || '.0,1E-7]' when 13 then '1e400' when 14 then '"' || event_id || '.10"'
  when 15 then '100000000000000000000000e-20' end"""
WHOLE = """case event_id % 16 when 0 then event_id when 1 then 1000 when 5 then 9007199254740993 when 6 then event_id * 100
  when 7 then 0 when 8 then 25 when 10 then 9223372036854775807 when 15 then 1000
  when 2 then case when event_id = 0 then 0 end end"""
ORACLES["values_as_written"] = f"""
select event_id, case when event_id % 16 = 14 then event_id || '.10' else token end as as_varchar, token as as_jsonb,
  cast(whole as bigint) as as_bigint, case when whole between -2147483648 and 2147483647 then whole::integer end as as_integer,
  case when whole is null or whole not between -2147483648 and 2147483647
    then 'Invalid type INTEGER for value ' || token end as integer_error
from (select event_id, {WRITTEN} as token, {WHOLE} as whole from events)"""

# Types: by p_partkey % 30, in the order of the definitions.
PART_TYPES = """case p_partkey % 30
  when 0 then 'TIMESTAMP' when 1 then 'DATE' when 2 then 'JSONB' when 3 then 'BIGINT' when 4 then 'INTEGER'
  when 5 then case when ('1000000' || p_size)::bigint > 2147483647 then 'BIGINT' else 'INTEGER' end
  when 6 then 'DOUBLE' when 7 then 'BOOLEAN' when 8 then 'CHAR' when 9 then 'UUID' when 10 then 'VARCHAR'
  when 11 then 'VARCHAR' when 12 then 'INTEGER' when 13 then 'INTEGER' when 14 then 'JSONB' when 15 then 'JSONB'
  when 16 then 'INTEGER' when 17 then 'VARCHAR' when 18 then 'JSONB' when 19 then 'JSONB' when 20 then 'CHAR'
  when 21 then 'JSONB' when 22 then 'VARCHAR' when 23 then 'VARCHAR' when 24 then 'JSONB' when 25 then 'BIGINT'
  when 26 then 'BIGINT' when 27 then 'DOUBLE' when 28 then 'BOOLEAN' when 29 then 'JSONB' end"""
PART_LENGTHS = """cast(case p_partkey % 30 when 8 then p_size when 10 then p_size
  when 11 then greatest(2, length(p_name)) when 17 then p_size when 20 then 36 when 22 then 1
  when 23 then 4096 end as integer)"""
PARTS = f"""(select 'part-' || p_partkey as name, "column", {PART_TYPES} as type, {PART_LENGTHS} as length,
  "column" = 'extra_size' or p_partkey % 30 in (17, 22, 28, 29) as nullable
  from part, (values ('part_size'), ('extra_size')) c("column"))"""

ORACLES["infer_types"] = f'select name, "column", type, length from {PARTS}'
ORACLES["nullability"] = f'select name, "column", nullable from {PARTS}'
ORACLES["column_ddl"] = f"""
select name, "column", '"' || "column" || '" ' || case type when 'DOUBLE' then 'DOUBLE PRECISION' else type end
  || case when type in ('CHAR', 'VARCHAR') then '(' || length || ')' else '' end
  || case when nullable then ' NULL' else ' NOT NULL' end as ddl
from {PARTS}"""

ORACLES["column_names"] = """
select event_id, event_type || '_count.html_part' || user_id || '.user_' || event_type || '_id' as "column"
from events"""

ORACLES["table_names"] = """
select event_id, 'com_acme_' || user_id || '_labs_' || event_type || '_page_view_x_' || (event_id % 4 + 1)
  as table_name from events"""

ORDER_SCHEMAS = """(select distinct 'com.v' || (o_custkey % 40) as vendor, 'order' as name,
  'jsonschema' as format, cast(o_orderkey % 2 + 1 as integer) as model,
  cast((o_orderkey // 2) % 12 as integer) as revision, cast((o_orderkey // 24) % 15 as integer) as addition
  from orders)"""

ORACLES["schema_latest"] = f"""
select vendor, name, model, count(*) as n_versions,
  '{URI_PREFIX}' || vendor || '/' || name || '/jsonschema/' || model || '-' ||
    max(revision * 1000 + addition) // 1000 || '-' || max(revision * 1000 + addition) % 1000 as latest_uri
from {ORDER_SCHEMAS} group by vendor, name, model"""

ORACLES["schema_until"] = f"""
select s.* from {ORDER_SCHEMAS} s join (
  select vendor, name, model, max(revision * 1000 + addition) as known from {ORDER_SCHEMAS}
  where revision <= 6 group by vendor, name, model) k using (vendor, name, model)
where s.revision * 1000 + s.addition <= k.known"""

ORACLES["schema_order"] = f"""
select *, cast(row_number() over (partition by vendor, name, model order by revision, addition) as integer) as place
from {ORDER_SCHEMAS}"""

ORACLES["schema_fetch"] = f"""
select *, case when addition < 10 then case revision % 3 when 0 then '{{"type":"object"}}' when 1 then '[1]'
    else '{{"type":5}}' end end as document,
  case when addition >= 10 then 'IgluError' when revision % 3 > 0 then 'InvalidSchema' end as failure
from {ORDER_SCHEMAS}"""

ORACLES["registry_priority"] = f"""
select *, repository || ':' || vendor as document from (
  select *, case when vendor like 'com.v1%' then 'mirror' when vendor like 'com.v2%' or vendor like 'com.v3%'
    then 'local' when addition % 2 = 0 then 'central' else 'mirror' end as repository
  from {ORDER_SCHEMAS})"""

ORACLES["remove_roots"] = """
select 'c' || c_custkey as name, pointer from customer,
  (values ('base'), ('seg'), ('nested/b'), ('nested/c'), ('extraField'), ('late')) p(pointer)"""

ORACLES["properties_union"] = """
select 'c' || c_custkey as name, "column",
  '"' || "column" || '" ' || case when "column" = 'seg' then 'VARCHAR(' || (10 + c_custkey % 5) || ')'
    else type end || case when "column" = 'base' then ' NOT NULL' else ' NULL' end as ddl,
  cast(case when "column" = 'nested.c' then 1 + c_custkey % 2 else version end as integer) as first_seen
from customer, (values ('base', 'BIGINT', 0), ('seg', '', 0), ('nested.b', 'DOUBLE PRECISION', 1),
  ('nested.c', 'BOOLEAN', 1), ('extra_field', 'JSONB', 1), ('late', 'TIMESTAMP', 2)) p("column", type, version)"""

ORACLES["migration_added_columns"] = """
select 'c' || c_custkey as name, "column", type from customer,
  (values ('base', 'BIGINT', 0), ('nested.b', 'DOUBLE', 1), ('nested.c', 'BOOLEAN', 1),
    ('extra_field', 'JSONB', 1), ('late', 'TIMESTAMP', 2)) p("column", type, version)
where case when "column" = 'nested.c' then 1 + c_custkey % 2 else version end > c_custkey % 3"""

STATE = """case when schema like '%/unknown/%' or schema like '%/purchase/%' then 'Missing'
  when schema like '%/props/jsonschema/1-0-2' then 'Outdated' else 'Match' end"""
ORACLES["table_state"] = f"""
select '{URI_PREFIX}' || schema as uri, {STATE} as table_state, count(*) as n
from ({ENTITIES}) where {PARSED} group by all"""

ORACLES["event_state_check"] = f"""
select uuid as event_id,
  coalesce(string_agg(distinct case when {STATE} = 'Missing' then '{URI_PREFIX}' || schema end, ','
    order by case when {STATE} = 'Missing' then '{URI_PREFIX}' || schema end), '') as missing,
  coalesce(string_agg(distinct case when {STATE} = 'Outdated' then '{URI_PREFIX}' || schema end, ','
    order by case when {STATE} = 'Outdated' then '{URI_PREFIX}' || schema end), '') as outdated,
  count(*) filter ({STATE} <> 'Match') = 0 as ok
from ({ENTITIES}) where {PARSED} group by uuid"""

ORACLES["state_put"] = f"""
select * from {ORDER_SCHEMAS} where model = 2 union all
select * from {ORDER_SCHEMAS} s where revision < 5 and not exists (
  select 1 from {ORDER_SCHEMAS} f where f.model = 2 and f.vendor = s.vendor and f.name = s.name
    and f.model = s.model)"""

ORACLES["comment_issues"] = f"""
select 't_' || c_custkey as table_name, case when c_custkey % 4 = 0 then 'Missing' else 'Invalid' end as issue,
  case c_custkey % 4
    when 0 then 'Iglu comment is missing in table t_' || c_custkey || '; The table will be ignored'
    when 1 then 'Comment on table t_' || c_custkey || ' (' || c_mktsegment
      || ') is not valid Iglu URI (INVALID_IGLUURI)'
    else 'Comment on table t_' || c_custkey || ' ({URI_PREFIX}com.customer/c' || c_custkey
      || '/jsonschema/1-x) is not valid Iglu URI (INVALID_SCHEMAVER)' end as message
from customer where c_custkey > 0 and c_custkey % 4 < 3"""

ORACLES["state_from_comments"] = """
select 'com.customer' as vendor, 'c' || c_custkey as name, 'jsonschema' as format, 1 as model, 0 as revision,
  addition from customer, (values (0), (1)) v(addition) where c_custkey % 4 = 3"""

TABLE_OF = f"""case when schema like '%DeviceInfo%' then 'org_acme_labs_device_info_2'
  else 'com_acme_' || split_part(schema, '/', 2) || '_1' end"""
GOOD_COUNTS = f"""
select 'events' as table_name, count(*) as n from events where {GOOD} union all
select {TABLE_OF}, count(*) from ({ENTITIES}) where {GOOD} group by 1"""
ORACLES["shred_event_counts"] = GOOD_COUNTS
ORACLES["batch_load_counts"] = GOOD_COUNTS
ORACLES["stream_load_counts"] = GOOD_COUNTS
ORACLES["route_counts"] = f"""{GOOD_COUNTS}
union all select '_bad', count(*) from events where {BAD}"""

ORACLES["good_events"] = f"""
select {EVENT_UUID} as event_id, cast(event_id as integer) as txn_id, {CLOCK} as collector_tstamp,
  'u' || user_id as user_id, value as geo_latitude, event_id % 2 = 1 as br_cookies, {TITLE} as page_title
from events where {GOOD}"""

FILLED = """app_id platform etl_tstamp collector_tstamp event event_id txn_id v_collector v_etl user_id
  user_ipaddress domain_userid domain_sessionidx network_userid geo_country geo_latitude page_url page_title
  br_name br_cookies refr_domain_userid domain_sessionid event_name""".split()
ORACLES["events_by_column"] = f"""
select unnest({FILLED}) as "column", count(*) as n from events where {GOOD} group by 1"""

ORACLES["entity_cells"] = f"""
select {EVENT_UUID} as root_id, 'u' || user_id as user_id, event_id % 2 = 0 as active,
  'city ' || (user_id % 7) as address_city, user_id + 10000 as address_zip_code,
  date_trunc('second', ts) as registered_at, value as score,
  '["a",' || user_id || ',{{"b":null}}]' as tags
from events where {GOOD} and user_id % 3 = 0"""

ORACLES["entity_cells_by_join"] = f"""
select {TABLE_OF.replace("case when", "case when schema like '%/unknown/%' then null when", 1)} as table_name,
  count(*) as n,
  cast(sum(case when schema like '%/unknown/%' then 1
    when schema like '%/props/%' and {CASE} = 6 then 1
    when schema like '%/user_profile/%' and {CASE} = 7 then 2
    when schema like '%/DeviceInfo/%' and {CASE} = 20 then 1 else 0 end) as bigint) as n_errors,
  count(case when schema like '%/props/%' and {CASE} in (6, 18, 19) then 1
    when schema like '%DeviceInfo%' and {CASE} = 20 then 1 end) as n_violations
from ({ENTITIES}) where {PARSED} group by 1"""

FAULT_VALUES = """(values
  (0, 'loader_parsing_error', 1, 'InvalidValue', 'event_id', 'Cannot parse event_id as UUID'),
  (1, 'loader_parsing_error', 1, 'FieldNumberMismatch', null, 'Expected 131 fields, found 130'),
  (2, 'loader_parsing_error', 1, 'InvalidValue', 'v_etl', 'Field v_etl cannot be empty'),
  (3, 'loader_runtime_error', 1, 'RuntimeError', null, 'value too long for type character(2)'),
  (4, 'loader_runtime_error', 1, 'RuntimeError', null, 'value too long for type character varying(50)'),
  (5, 'loader_iglu_error', 1, 'SchemaListNotFound', null, 'No schemas found for com.acme/unknown/1-*-*'),
  (6, 'loader_iglu_error', 1, 'WrongType', '/k', 'Invalid type BIGINT for value "many"'),
  (7, 'loader_iglu_error', 2, 'WrongType', '/active', 'Invalid type BOOLEAN for value 1'),
  (8, 'loader_parsing_error', 1, 'InvalidValue', 'dvce_created_tstamp',
    'Cannot parse dvce_created_tstamp as TIMESTAMP'),
  (9, 'loader_parsing_error', 1, 'InvalidValue', 'contexts', 'Cannot parse contexts as JSON'),
  (10, 'loader_parsing_error', 1, 'NotTSV', null, 'Line is not tab-separated'),
  (11, 'loader_parsing_error', 1, 'InvalidValue', 'br_cookies', 'Cannot parse br_cookies as BOOLEAN'),
  (12, 'loader_parsing_error', 1, 'InvalidValue', 'domain_sessionidx',
    'Cannot parse domain_sessionidx as INTEGER'),
  (13, 'loader_parsing_error', 1, 'InvalidValue', 'geo_latitude', 'Cannot parse geo_latitude as DOUBLE'),
  (14, 'loader_parsing_error', 1, 'InvalidValue', 'collector_tstamp',
    'Cannot parse collector_tstamp as TIMESTAMP'),
  (15, 'loader_parsing_error', 2, 'InvalidValue', 'domain_sessionidx',
    'Cannot parse domain_sessionidx as INTEGER'),
  (18, 'loader_runtime_error', 1, 'RuntimeError', null, 'value too long for type character varying(20)'),
  (19, 'loader_runtime_error', 1, 'RuntimeError', null,
    'null value in column "k" violates not-null constraint'),
  (20, 'loader_iglu_error', 1, 'WrongType', '/deviceId', 'Invalid type UUID for value "no-uuid"'),
  (24, 'loader_parsing_error', 1, 'InvalidValue', 'contexts', 'Cannot parse contexts as JSON')
  ) f(number, kind, n_errors, error, field, message)"""

ORACLES["bad_rows"] = f"""
select case when number <> 10 then cast(event_id as varchar) end as txn_id, kind,
  cast(n_errors as integer) as n_errors, error, field, message
from events join {FAULT_VALUES} on {CASE} = number"""

ORACLES["bad_row_documents"] = f"""
select case when number <> 10 then cast(event_id as varchar) end as txn_id, kind, '{NAME}' as artifact, error
from events join {FAULT_VALUES} on {CASE} = number"""

ORACLES["constraint_violations"] = f"""
select cast(event_id as varchar) as txn_id, message
from events join {FAULT_VALUES} on {CASE} = number where {CASE} in ({listed(RUNTIME_CASES)})"""

OUTCOME = f"""case when {CASE} in ({listed(PARSING_CASES)}) then 'loader_parsing_error'
  when {CASE} in ({listed(SCHEMA_CASES)}) then 'loader_iglu_error'
  when {CASE} in ({listed(RUNTIME_CASES)}) then 'loader_runtime_error' else 'good' end"""
ORACLES["atomic_event_split"] = f"""
select {OUTCOME} as outcome, count(*) as n,
  cast(sum(case when {CASE} in ({listed(PARSING_CASES)}) then 0
    else 3 + ({CASE} in (5, 21))::int + (user_id % 3 = 0 or {CASE} = 7)::int end) as bigint) as n_entities
from events group by 1"""

ORACLES["discard_counts"] = f"""
select case when {CASE} <> 10 then time_bucket(interval '30 seconds', {CLOCK}) end as period_start, count(*) as discarded
from events where {BAD} group by 1"""

ORACLES["pii_projection"] = f"""
select repeat(md5('i' || user_id), 4) as user_ipaddress, repeat(md5('d' || user_id), 4) as domain_userid,
  repeat(md5('n' || user_id), 4) as network_userid, repeat(md5('r' || user_id), 4) as refr_domain_userid,
  repeat(md5('s' || user_id), 4) as domain_sessionid
from events where {GOOD}"""

ORACLES["event_ids"] = f"select {EVENT_UUID} as event_id from events where {GOOD}"

ORACLES["loaded_table_rows"] = f"""
select 'com.acme' as schema_vendor, 'props' as schema_name, 'jsonschema' as schema_format,
  '1-0-' || (event_id % 3) as schema_version, uuid as root_id, {CLOCK} as root_tstamp,
  cast(json_extract_string(props, '$.k') as bigint) as k,
  case when event_id % 3 > 0 then 'label ' || user_id end as label,
  case when event_id % 3 = 2 then value end as ratio
from ({ENTITIES}) where {GOOD} and schema like '%/props/%'"""

ORACLES["evolved_load_rows"] = f"""
select schema_version, root_id, k, label, ratio from ({ORACLES["loaded_table_rows"]})"""

ORACLES["loaded_columns"] = f"""
with loaded as ({ORACLES["loaded_table_rows"]})
select unnest(['schema_vendor', 'schema_name', 'schema_format', 'schema_version', 'root_id', 'root_tstamp', 'k', 'label', 'ratio']) as column_name,
  unnest(range(9)) as position,
  unnest(['varchar(128)', 'varchar(128)', 'varchar(128)', 'varchar(128)', 'string', 'timestamp_ntz', 'bigint', 'varchar(20)',
    'double']) as data_type,
  unnest([count(schema_vendor), count(schema_name), count(schema_format), count(schema_version), count(root_id),
    count(root_tstamp), count(k), count(label), count(ratio)]) as n
from loaded"""

ORACLES["two_loads_counts"] = f"select table_name, 2 * n as n from ({GOOD_COUNTS})"

ORACLES["collision_bad_rows"] = f"""
select case when {CASE} in ({listed(PARSING_CASES)}) then 'loader_parsing_error'
    when {EVENT_UUID} in (select uuid from ({ENTITIES}) where schema like '%/props/%') then 'collision'
    else {OUTCOME} end as outcome, count(*) as n
from events group by 1"""

ORACLES["widened_events"] = f"""
select {EVENT_UUID} as event_id, repeat(md5('s' || user_id), 4) as domain_sessionid, 'DE' as geo_country,
  'varchar(36)' as before, 'varchar(128)' as after, true as refused
from events where {GOOD}"""

FIRST_HALF = GOOD_COUNTS.replace(f"where {GOOD}", f"where {GOOD} and event_id % 2 = 0")
ORACLES["replayed_batch_counts"] = f"""
select a.table_name, a.n, coalesce(b.n, 0) as n_stopped, coalesce(b.n, 0) as n_before
from ({GOOD_COUNTS}) a left join ({FIRST_HALF}) b using (table_name)"""

# In the first half only ``k`` is known, so a label that is too long spoils no event.
ORACLES["altered_table_rows"] = f"""
select '1-0-' || (event_id % 3) as schema_version, uuid as root_id,
  cast(json_extract_string(props, '$.k') as bigint) as k,
  case when event_id % 2 = 1 and event_id % 3 > 0 then 'label ' || user_id end as label,
  case when event_id % 2 = 1 and event_id % 3 = 2 then value end as ratio, 7::bigint as columns_before,
  '{URI_PREFIX}com.acme/props/jsonschema/1-0-0' as comment_before,
  '{URI_PREFIX}com.acme/props/jsonschema/1-0-2' as comment_after
from ({ENTITIES}) where ({GOOD} or ({CASE} = 18 and event_id % 2 = 0)) and schema like '%/props/%'"""

ORACLES["existing_tables"] = f"""
with named as (select distinct {TABLE_OF} as table_name, split_part(schema, '/', 2) as name from ({ENTITIES}) where {PARSED})
select table_name, name <> 'unknown' as is_there, case name when 'unknown' then null
    when 'DeviceInfo' then '{URI_PREFIX}org.acme-labs/DeviceInfo/jsonschema/2-0-1'
    else '{URI_PREFIX}com.acme/' || name || '/jsonschema/1-0-' || case name when 'props' then 2 else 0 end end as comment
from named"""

ORACLES["bad_row_files"] = f"select {OUTCOME} as kind, count(*) as n from events where {BAD} group by 1"

ORACLES["capped_record_batches"] = """
select event_id, count(*) as times, true as within_cap, true as many_batches from events group by event_id"""

ORACLES["records_since_timestamp"] = """
select ts as arrived, event_id from events
where ts >= (select min(ts) + (max(ts) - min(ts)) / 2 from events)"""

ORACLES["stream_discard_reports"] = f"select count(*) as discarded, false as any_empty, true as any_report from events where {BAD}"

ORACLES["bounded_puts"] = f"""
select case when {CASE} = 10 then null else event_id end as txn_id, count(*) as times, true as bounded
from events where {BAD} group by 1"""
