import collections
import json
import random

import pytest
from pyspark.sql import types as T

from landgate.operators.drift import common_types, declared_types, found_types, schema_drift, shape_fields

DDL = (
    "id string, n bigint, price double, ok boolean, day date, tags array<string>, "
    "parts array<struct<k:string, v:bigint>>, deep struct<a:struct<b:int>>, `a.b` string, _corrupt_record string"
)


@pytest.fixture(scope="module")
def schema(spark):
    return T.StructType.fromDDL(DDL)


def kind(v):
    if v is None:
        return "null"
    names = {bool: "boolean", int: "integer", float: "number", str: "string", list: "array", dict: "object"}
    return names[type(v)]


def walk(v, path, out):
    out[path, kind(v)] += 1
    if isinstance(v, dict):
        for k, x in v.items():
            walk(x, k if path == "$" else f"{path}.{k}", out)


def texts(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_counts_are_those_of_walking_every_record(spark):
    dice, rows, want = random.Random(2), [], collections.Counter()
    values = [None, 1, 2.5, "x", True, {"in": 1, "null": None}, {}, {"deep": {"er": "y"}}]
    for _ in range(600):
        record = {k: dice.choice(values) for k in ("a", "b", "c", "OBJECT", "x1") if dice.random() < 0.7}
        rows.append(json.dumps(record))
        walk(record, "$", want)
    rows += ["{broken", None, "", '{"a":1,"a":2}']
    want["$", "broken"] = 4
    got = {(r.path, r.found): r.records for r in found_types(texts(spark, rows)).collect()}
    assert got == dict(want)


def test_arrays_odd_names_and_scalars(spark):
    rows = [
        '{"tags":["a","b"],"parts":[{"k":"x"},{"k":"y","v":3}],"a.b":1,"we`ird: <n>, x":[[1]]}', '{"tags":["a",1]}', '{"tags":[]}', "7", '"t"',
        '{"n":12345678901234567890}', '{"n":1e400}',
    ]
    got = {(r.path, r.found): r.records for r in found_types(texts(spark, rows)).collect()}
    assert got["tags", "array"] == 3 and got["tags[]", "string"] == 1 and got["tags[]", "mixed"] == 1
    assert got["parts[]", "object"] == got["parts[].k", "string"] == got["parts[].v", "integer"] == 1
    assert got["`a.b`", "integer"] == 1 and got["`we``ird: <n>, x`[][]", "integer"] == 1
    assert got["$", "integer"] == got["$", "string"] == 1


def test_fractions_of_zeros_strings_and_long_texts(spark):
    rows = [
        '{"n":5.0,"m":-0.00,"s":"1.0, \\"2.0\\" 3.0","l":[1.0,2.0],"e":1e2,"f":1.0e2,"i":10}', '{"n":1.}', '{"n":.5}', '{"n":"1.0}',
        json.dumps({"s": "a\"\\.1 " * 60000, "n": 7.0, "l": [1.0] * 50000}),
    ]
    got = {(r.path, r.found): r.records for r in found_types(texts(spark, rows)).collect()}
    assert got == {
        ("$", "object"): 2, ("$", "broken"): 3, ("n", "number"): 2, ("m", "number"): 1, ("s", "string"): 2, ("l", "array"): 2,
        ("l[]", "number"): 2, ("e", "number"): 1, ("f", "number"): 1, ("i", "integer"): 1,
    }


def test_drift_names_what_departs(spark, schema):
    rows = ['{"id":"x","n":1,"price":2,"day":"2026-01-01"}', '{"id":5,"n":"one","price":null,"new":{"x":1}}', "{", '{"n":2.5,"a.b":"t"}']
    got = {(r.path, r.found): (r.records, r.verdict) for r in schema_drift(texts(spark, rows), schema, skip="_corrupt_record").collect()}
    assert got["id", "string"] == (1, "fits") and got["id", "integer"] == (1, "fits")
    assert got["n", "integer"] == (1, "fits") and got["n", "string"] == got["n", "number"] == (1, "wrong type")
    assert got["price", "integer"] == (1, "fits") and got["price", "null"] == (1, "null")
    assert got["new", "object"] == got["new.x", "integer"] == (1, "undeclared")
    assert got["$", "broken"] == (1, "broken") and got["$", "object"] == (3, "fits")
    assert got["`a.b`", "string"] == (1, "fits") and got["day", "string"] == (1, "fits")
    for path in ("ok", "tags", "tags[]", "parts[].v", "deep.a.b"):
        assert got[path, None] == (0, "never seen")
    assert ("_corrupt_record", None) not in got


def test_an_empty_table_has_seen_nothing(spark, schema):
    got = schema_drift(texts(spark, ["{}"]).limit(0), schema).collect()
    assert {r.verdict for r in got} == {"never seen"} and len(got) == len(declared_types(schema))


@pytest.mark.parametrize("values, want", [
    ([1, 2], "bigint"), ([1, 2.5, None], "double"), (["a", None], "string"), ([1, "a"], "variant"), ([None], "void"),
    ([{"x": 1}, {}], "struct"), ([[1]], "array"), ([True], "boolean"), ([{"x": 1}, 1], "variant"),
])
def test_the_common_type(spark, values, want):
    found = found_types(texts(spark, [json.dumps({"f": v}) for v in values]))
    assert {r.path: r.type for r in common_types(found).collect()}["f"] == want


def test_shapes_are_taken_apart():
    assert shape_fields("OBJECT<>") == [("$", "object")]
    assert shape_fields("OBJECT<a: ARRAY<OBJECT<b: DECIMAL(3,1)>>, c: VOID>") == [
        ("$", "object"), ("a", "array"), ("a[]", "object"), ("a[].b", "number"), ("c", "null"),
    ]
