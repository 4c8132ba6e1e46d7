import pytest
from pyspark.sql import functions as F

from distributary.functions.casts import cast_json, ddl_name
from distributary.functions.column_types import can_be_null, infer_type, schema_keywords
from distributary.functions.json_values import get_path, parse_document, plain_text

CASES = [
    ('{"type":"string","format":"date-time"}', "TIMESTAMP", False),
    ('{"type":"string","format":"date"}', "DATE", False),
    ('{"type":"array"}', "JSONB", False),
    ('{"type":"integer"}', "BIGINT", False),
    ('{"type":"integer","maximum":100}', "INTEGER", False),
    ('{"type":"integer","maximum":10000000000}', "BIGINT", False),
    ('{"type":"integer","maximum":10000000000.5}', "INTEGER", False),
    ('{"type":"integer","maximum":100,"enum":[3000000000]}', "INTEGER", False),
    ('{"type":"number"}', "DOUBLE PRECISION", False),
    ('{"type":"boolean"}', "BOOLEAN", False),
    ('{"type":"string","minLength":42,"maxLength":42}', "CHAR(42)", False),
    ('{"type":"string","format":"uuid"}', "UUID", False),
    ('{"type":"string","format":"uuid","minLength":36,"maxLength":36}', "CHAR(36)", False),
    ('{"type":"string","maxLength":42}', "VARCHAR(42)", False),
    ('{"enum":["xxx","yyy"]}', "VARCHAR(3)", False),
    ('{"enum":[1,2]}', "INTEGER", False),
    ('{"type":"integer","enum":[1,2]}', "INTEGER", False),
    ('{"enum":[12345,"y"]}', "JSONB", False),
    ('{"enum":[true,false]}', "JSONB", False),
    ('{"enum":["a",null]}', "VARCHAR(1)", True),
    ('{"enum":[null]}', "JSONB", True),
    ('{"type":"integer","enum":[null]}', "BIGINT", True),
    ('{"type":"number","multipleOf":5}', "INTEGER", False),
    ('{"type":"string","multipleOf":5}', "INTEGER", False),
    ('{"type":"number","multipleOf":0.01}', "DOUBLE PRECISION", False),
    ('{"type":["string","null"]}', "VARCHAR(4096)", True),
    ('{"type":["integer","number"]}', "JSONB", False),
    ('{"type":["array","null"]}', "JSONB", True),
    ('{"type":"null"}', "JSONB", True),
    ("{}", "JSONB", False),
]


def test_inference(spark):
    rows = [(i, c[0]) for i, c in enumerate(CASES)]
    definitions = spark.createDataFrame(rows, "i int, d string")
    typed = definitions.withColumn("k", schema_keywords(F.parse_json("d")))
    typed = typed.withColumn("t", infer_type(F.col("k")))
    ddl = ddl_name(F.col("t.type"), F.col("t.length"))
    found = typed.select("i", ddl.alias("ddl"), can_be_null(F.col("k")).alias("n")).collect()
    assert {r.i: (r.ddl, r.n) for r in found} == {i: c[1:] for i, c in enumerate(CASES)}


@pytest.mark.parametrize(
    ("kind", "length", "accepted", "refused"),
    [
        ("UUID", None, {'"97C89CB7-5db2-412a-976c-418e50f823b3"': "97c89cb7-5db2-412a-976c-418e50f823b3"}, ['"x"', "1", "true"]),
        ("VARCHAR", 3, {'"longer"': "longer", "1": "1", "true": "true", '{"a":[1]}': '{"a":[1]}'}, []),
        ("BOOLEAN", None, {"true": True, "false": False}, ['"true"', "1", "[true]"]),
        ("CHAR", 3, {'"abc"': "abc"}, ['"ab"', '"abcd"', "123"]),
        ("INTEGER", None, {"1": 1, "1.0": 1, "1e3": 1000, "-0": 0, "2147483647": 2147483647}, ["1.5", "2147483648", '"1"', "true", "{}"]),
        ("BIGINT", None, {"9223372036854775807": 9223372036854775807, "3e9": 3000000000}, ["9223372036854775808", "0.1", '"1"']),
        ("DOUBLE", None, {"1": 1.0, "1.25": 1.25, "1e-3": 0.001}, ['"1"', "false", "[]"]),
        ("JSONB", None, {'"a"': '"a"', "[1,null]": "[1,null]", "1": "1"}, []),
        ("DATE", None, {}, ['"2024-13-01"', '"2024-01-01T00:00:00Z"', "20240101"]),
        ("TIMESTAMP", None, {}, ['"2024-01-01"', '"2024-01-01T00:00:00"', '"2024-01-01T00:00:00+01:00"', '"2024-02-30T00:00:00Z"', "5"]),
    ],
)
def test_casts(spark, kind, length, accepted, refused):
    tokens = [*accepted, *refused, "null"]
    documents = spark.createDataFrame([(t, f'{{"v":{t}}}') for t in tokens], "t string, d string")
    value, error = cast_json(get_path(F.parse_json("d"), ["v"]), kind, length)
    found = {r.t: (r.v, r.e) for r in documents.select("t", value.alias("v"), error.alias("e")).collect()}
    for token, expected in accepted.items():
        assert found[token] == (expected, None)
    for token in refused:
        assert found[token][0] is None and found[token][1]
    assert found["null"] == (None, None)


def test_instants_and_dates(spark):
    rows = [("2619-08-18T00:00:00.123456789Z",), ("0001-01-01T00:00:00Z",), ("2024-02-29t01:02:03z",)]
    instants = spark.createDataFrame(rows, "s string").withColumn("d", F.to_json(F.struct(F.col("s").alias("v"))))
    value, error = cast_json(get_path(F.parse_json("d"), ["v"]), "TIMESTAMP")
    found = instants.select(value.cast("string").alias("v"), error.alias("e")).collect()
    assert [r.v for r in found] == ["2619-08-18 00:00:00.123456", "0001-01-01 00:00:00", "2024-02-29 01:02:03"]
    assert all(r.e is None for r in found)


def test_one_document_only(spark):
    good = ['{"a":1}', ' [1,2] ', '"x"', "1", '{"a":1,"a":2}']
    bad = ["", "{", '{"a":1} x', "1,2", "1],[2", "1] x", '1,"b"', "{'a':1}", "NaN", "{},{}"]
    documents = spark.createDataFrame([(t,) for t in good + bad], "t string")
    parsed = documents.select("t", parse_document(F.col("t")).isNotNull().alias("ok")).collect()
    assert {r.t for r in parsed if r.ok} == set(good)


def test_last_of_equal_keys_wins(spark):
    row = spark.createDataFrame([('{"a":1,"a":2}',)], "t string")
    value = plain_text(get_path(parse_document(F.col("t")), ["a"]))
    assert row.select(value.alias("v")).first().v == "2"


def test_pointer_steps(spark):
    with pytest.raises(ValueError):
        get_path(F.lit(None), [None])
