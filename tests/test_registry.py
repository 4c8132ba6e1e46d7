import json

import pytest
from pyspark.sql import functions as F

from distributary.functions.schema_uri import KEY_COLUMNS, URI_PREFIX
from distributary.operators.registry import added_columns, column_table, invalid_groups
from distributary.operators.state import MISSING, OUTDATED, table_state
from distributary.sources.registry import read_registry

VENDOR = "net.quillhouse"
TEXT, DAY, FLAG = {"type": "string"}, {"type": "string", "format": "date"}, {"type": "boolean"}
COPIES = {"type": "integer", "maximum": 900}


def about(name: str, version: str) -> dict:
    return {"vendor": VENDOR, "name": name, "format": "jsonschema", "version": version}


def document(name: str, properties: dict, version: str = "1-0-0", required: tuple[str, ...] = ()) -> dict:
    return {"self": about(name, version), "type": "object", "properties": properties, "required": list(required)}


# A slip for a lent book: two revisions with two versions each, of which only the first has mandatory columns.
SLIP = {"due": DAY, "renewable": FLAG, "copiesHeld": COPIES}
SHELF = {"shelf": {"type": "string", "minLength": 4, "maxLength": 4}}
FEE = {"fee": {"type": "object", "properties": {"currency": {"enum": ["EUR", "DKK"]}, "amount": {"type": "number"}}}}
BRANCH = {"branch": {"enum": ["north", "south", "pier"]}, "remarks": {"type": "array"}}
SLIPS = [
    document("LoanSlip", SLIP, "2-0-0", ("renewable", "due")),
    document("LoanSlip", SLIP | SHELF, "2-0-1", ("renewable", "due")),
    document("LoanSlip", SLIP | SHELF | FEE, "2-1-0", ("due",)),
    document("LoanSlip", SLIP | SHELF | FEE | BRANCH, "2-1-1", ("due", "branch")),
]
# By hand: mandatory ones of the first version by name, its other ones by name, then additions version by version as written.
SLIP_COLUMNS = [
    '"due" DATE NOT NULL',
    '"renewable" BOOLEAN NOT NULL',
    '"copies_held" INTEGER NULL',
    '"shelf" CHAR(4) NULL',
    '"fee.currency" VARCHAR(3) NULL',
    '"fee.amount" DOUBLE PRECISION NULL',
    '"branch" VARCHAR(5) NULL',
    '"remarks" JSONB NULL',
]


def write_registry(folder, documents):
    for i, content in enumerate(documents):
        path = folder / content["self"]["vendor"] / f"{i}"
        path.mkdir(parents=True)
        (path / content["self"]["version"]).write_text(json.dumps(content))
    return str(folder)


@pytest.fixture
def slips(spark, tmp_path):
    return read_registry(spark, [write_registry(tmp_path / "slips", SLIPS)])


def test_columns_over_two_revisions(slips):
    found = column_table(slips).orderBy("position").select("ddl").collect()
    assert [r.ddl for r in found] == SLIP_COLUMNS


def test_columns_that_a_table_lacks(slips):
    for known, missing in (
        ("revision = 0 and addition = 0", {"shelf", "fee.amount", "fee.currency", "branch", "remarks"}),
        ("revision = 1 and addition = 0", {"branch", "remarks"}),
    ):
        found = added_columns(column_table(slips), slips.where(known)).select("column").collect()
        assert {r.column for r in found} == missing


def test_the_first_folder_wins(spark, tmp_path):
    other = document("LoanSlip", {"lender": TEXT}, "2-0-0")
    folders = [write_registry(tmp_path / n, [d]) for n, d in (("ours", SLIPS[0]), ("theirs", other))]
    for order, expected in ((folders, "renewable"), (folders[::-1], "lender")):
        rows = read_registry(spark, order).collect()
        assert len(rows) == 1 and expected in rows[0].document


def test_a_property_that_gains_parts_leaves_only_those(spark, tmp_path):
    bare = document("stamp", {"mark": {"type": "object"}, "ink": TEXT})
    parts = document("stamp", {"mark": {"type": "object", "properties": {"wide": FLAG, "code": COPIES}}, "ink": TEXT}, "1-0-1")
    schemas = read_registry(spark, [write_registry(tmp_path / "r", [bare, parts])])
    assert {r.column for r in column_table(schemas).select("column").collect()} == {"ink", "mark.wide", "mark.code"}


def test_table_state(spark):
    types = "vendor string, name string, format string, model int, revision int, addition int"
    slip = (VENDOR, "LoanSlip", "jsonschema")
    reflected = spark.createDataFrame([(*slip, 2, 0, 1), (*slip, 2, 1, 0)], types)
    itself = (VENDOR, "visit", "jsonschema", 1, 0, 0)
    expected = {(*slip, 2, 1, 0): "Match", (*slip, 2, 1, 1): OUTDATED, (*slip, 5, 0, 0): MISSING, itself: "Match"}
    asked = spark.createDataFrame([key for key in expected for _ in range(3)], types)
    checked = table_state(asked, reflected, f"{URI_PREFIX}{VENDOR}/visit/jsonschema/1-0-0").collect()
    assert len(checked) == 3 * len(expected)
    assert {tuple(r[c] for c in KEY_COLUMNS): r.table_state for r in checked} == expected


def test_names_that_meet_spoil_their_groups(spark, tmp_path):
    documents = [
        document("pair", {"shelfMark": TEXT, "shelf_mark": TEXT}),
        document("origin", {"schemaVendor": TEXT}),
        document("desk-log", {"a": TEXT}),
        document("desk_log", {"a": TEXT}),
        document("fine", {"a": TEXT}),
        document("torn", {}) | {"type": 5},
    ]
    schemas = read_registry(spark, [write_registry(tmp_path / "r", documents)])
    found = {r.name: r.problem for r in invalid_groups(schemas, column_table(schemas), ["schema_vendor"]).collect()}
    assert found.pop("torn") == f"{URI_PREFIX}{VENDOR}/torn/jsonschema/1-0-0 cannot be parsed as JSON Schema"
    kinds = {name: problem.split(" ")[0] for name, problem in found.items()}
    assert kinds == {"pair": "column", "origin": "column", "desk-log": "table", "desk_log": "table"}


def test_version_numbers_are_numbers(spark):
    order = F.struct("revision", "addition")
    rows = spark.createDataFrame([(0, 9), (0, 10)], "revision int, addition int")
    assert rows.orderBy(order.desc()).first().addition == 10
