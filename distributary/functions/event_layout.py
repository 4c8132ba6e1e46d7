"""Layout of an enriched event line: 131 tab-separated fields, in order."""

from __future__ import annotations

from typing import NamedTuple

# The field order, column types and NOT NULL marks of the data format.
EVENT_LAYOUT = """
app_id VARCHAR(255)
platform VARCHAR(255)
etl_tstamp TIMESTAMP
collector_tstamp TIMESTAMP NOT NULL
dvce_created_tstamp TIMESTAMP
event VARCHAR(128)
event_id UUID NOT NULL
txn_id INTEGER
name_tracker VARCHAR(128)
v_tracker VARCHAR(100)
v_collector VARCHAR(100) NOT NULL
v_etl VARCHAR(100) NOT NULL
user_id VARCHAR(255)
user_ipaddress VARCHAR(128)
user_fingerprint VARCHAR(50)
domain_userid VARCHAR(128)
domain_sessionidx INTEGER
network_userid VARCHAR(128)
geo_country CHAR(2)
geo_region CHAR(3)
geo_city VARCHAR(75)
geo_zipcode VARCHAR(15)
geo_latitude DOUBLE
geo_longitude DOUBLE
geo_region_name VARCHAR(100)
ip_isp VARCHAR(100)
ip_organization VARCHAR(100)
ip_domain VARCHAR(100)
ip_netspeed VARCHAR(100)
page_url VARCHAR(4096)
page_title VARCHAR(2000)
page_referrer VARCHAR(4096)
page_urlscheme VARCHAR(16)
page_urlhost VARCHAR(255)
page_urlport INTEGER
page_urlpath VARCHAR(3000)
page_urlquery VARCHAR(6000)
page_urlfragment VARCHAR(3000)
refr_urlscheme VARCHAR(16)
refr_urlhost VARCHAR(255)
refr_urlport INTEGER
refr_urlpath VARCHAR(6000)
refr_urlquery VARCHAR(6000)
refr_urlfragment VARCHAR(3000)
refr_medium VARCHAR(25)
refr_source VARCHAR(50)
refr_term VARCHAR(255)
mkt_medium VARCHAR(255)
mkt_source VARCHAR(255)
mkt_term VARCHAR(255)
mkt_content VARCHAR(500)
mkt_campaign VARCHAR(255)
contexts JSON
se_category VARCHAR(1000)
se_action VARCHAR(1000)
se_label VARCHAR(1000)
se_property VARCHAR(1000)
se_value DOUBLE
unstruct_event JSON
tr_orderid VARCHAR(255)
tr_affiliation VARCHAR(255)
tr_total DOUBLE
tr_tax DOUBLE
tr_shipping DOUBLE
tr_city VARCHAR(255)
tr_state VARCHAR(255)
tr_country VARCHAR(255)
ti_orderid VARCHAR(255)
ti_sku VARCHAR(255)
ti_name VARCHAR(255)
ti_category VARCHAR(255)
ti_price DOUBLE
ti_quantity INTEGER
pp_xoffset_min INTEGER
pp_xoffset_max INTEGER
pp_yoffset_min INTEGER
pp_yoffset_max INTEGER
useragent VARCHAR(1000)
br_name VARCHAR(50)
br_family VARCHAR(50)
br_version VARCHAR(50)
br_type VARCHAR(50)
br_renderengine VARCHAR(50)
br_lang VARCHAR(255)
br_features_pdf BOOL
br_features_flash BOOL
br_features_java BOOL
br_features_director BOOL
br_features_quicktime BOOL
br_features_realplayer BOOL
br_features_windowsmedia BOOL
br_features_gears BOOL
br_features_silverlight BOOL
br_cookies BOOL
br_colordepth VARCHAR(12)
br_viewwidth INTEGER
br_viewheight INTEGER
os_name VARCHAR(50)
os_family VARCHAR(50)
os_manufacturer VARCHAR(50)
os_timezone VARCHAR(50)
dvce_type VARCHAR(50)
dvce_ismobile BOOL
dvce_screenwidth INTEGER
dvce_screenheight INTEGER
doc_charset VARCHAR(128)
doc_width INTEGER
doc_height INTEGER
tr_currency CHAR(3)
tr_total_base DOUBLE
tr_tax_base DOUBLE
tr_shipping_base DOUBLE
ti_currency CHAR(3)
ti_price_base DOUBLE
base_currency CHAR(3)
geo_timezone VARCHAR(64)
mkt_clickid VARCHAR(128)
mkt_network VARCHAR(64)
etl_tags VARCHAR(500)
dvce_sent_tstamp TIMESTAMP
refr_domain_userid VARCHAR(128)
refr_dvce_tstamp TIMESTAMP
derived_contexts JSON
domain_sessionid VARCHAR(128)
derived_tstamp TIMESTAMP
event_vendor VARCHAR(1000)
event_name VARCHAR(1000)
event_format VARCHAR(128)
event_version VARCHAR(128)
event_fingerprint VARCHAR(128)
true_tstamp TIMESTAMP
"""

# Columns put before the properties of an entity that came with an event.
META_LAYOUT = """
schema_vendor VARCHAR(128)
schema_name VARCHAR(128)
schema_format VARCHAR(128)
schema_version VARCHAR(128)
root_id UUID
root_tstamp TIMESTAMP
"""

# Table of the scalar fields, cut length of its strings.
EVENTS_TABLE = "events"
ATOMIC_STRING_LIMIT = 1024

# Target type names and the Spark type that stores each of them.
SPARK_TYPES = {
    "CHAR": "string",
    "VARCHAR": "string",
    "UUID": "string",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "JSONB": "string",
}


class Field(NamedTuple):
    """One column: name, target type name, declared length (CHAR and VARCHAR) and nullability."""

    name: str
    kind: str
    length: int | None
    nullable: bool

    @property
    def spark_type(self) -> str:
        """Type of the column in a DataFrame."""
        return SPARK_TYPES[self.kind]

    @property
    def table_type(self) -> str:
        """Type of the column in a Spark table."""
        if self.length is not None:
            return f"{self.kind}({self.length})"
        return SPARK_TYPES[self.kind]


def parse_layout(text: str) -> list[Field]:
    fields = []
    for line in text.strip().splitlines():
        name, type_text, *rest = line.split()
        kind, _, length = type_text.rstrip(")").partition("(")
        kind = {"BOOL": "BOOLEAN"}.get(kind, kind)
        fields.append(Field(name, kind, int(length) if length else None, not rest))
    return fields


LINE_FIELDS = parse_layout(EVENT_LAYOUT)
JSON_FIELDS = [f.name for f in LINE_FIELDS if f.kind == "JSON"]
ATOMIC_FIELDS = [f for f in LINE_FIELDS if f.kind != "JSON"]
META_FIELDS = parse_layout(META_LAYOUT)
