import json

import pytest
from pyspark.sql import types as T

from topicflow import decode_payload, expand_payload, from_avro_text, to_avro_text

PERSON = {
    "type": "record", "name": "person", "namespace": "people", "fields": [
        {"name": "id", "type": "long"},
        {"name": "name", "type": ["null", "string"]},
        {"name": "born", "type": {"type": "int", "logicalType": "date"}},
        {"name": "seen", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]},
        {"name": "local", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
        {"name": "pay", "type": [{"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}, "null"]},
        {"name": "kind", "type": {"type": "enum", "name": "kind", "symbols": ["a", "b"]}},
        {"name": "again", "type": ["null", "kind"]},
        {"name": "code", "type": {"type": "fixed", "name": "code", "size": 4}},
        {"name": "home", "type": {"type": "record", "name": "place", "fields": [{"name": "town", "type": "string"}]}},
        {"name": "others", "type": {"type": "array", "items": ["null", "people.place"]}},
        {"name": "tags", "type": {"type": "map", "values": "double"}},
        {"name": "count", "type": ["int", "long"]},
        {"name": "share", "type": ["null", "float", "double"]},
        {"name": "either", "type": ["string", "null", "long"]},
        {"name": "id_text", "type": {"type": "string", "logicalType": "uuid"}},
        {"name": "nothing", "type": "null"},
        {"name": "maybe", "type": {"type": ["null", "boolean"]}},
    ],
}


def test_declared_types():
    place = "struct<town:string>"
    wanted = {
        "id": ("bigint", False), "name": ("string", True), "born": ("date", False), "seen": ("timestamp", True),
        "local": ("timestamp_ntz", False), "pay": ("decimal(9,2)", True), "kind": ("string", False),
        "again": ("string", True), "code": ("binary", False), "home": (place, False), "others": (f"array<{place}>", False),
        "tags": ("map<string,double>", False), "count": ("bigint", False), "share": ("double", True),
        "either": ("struct<member0:string,member1:bigint>", True), "id_text": ("string", False), "nothing": ("void", True),
        "maybe": ("boolean", True),
    }
    got = from_avro_text(json.dumps(PERSON))
    assert {f.name: (f.dataType.simpleString(), f.nullable) for f in got.fields} == wanted
    assert got["others"].dataType.containsNull and not got["tags"].dataType.valueContainsNull


def test_round_trip():
    schema = from_avro_text(json.dumps(PERSON))
    again = from_avro_text(to_avro_text(schema))
    assert again == schema and from_avro_text(to_avro_text(again)) == schema
    small = T.StructType([T.StructField("b", T.ByteType(), False), T.StructField("s", T.ShortType())])
    assert from_avro_text(to_avro_text(small)).simpleString() == "struct<b:int,s:int>"


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ("{", "not JSON"), ('"long"', "must be a record"), ('["null", "string"]', "must be a record"),
        ('{"type": "record", "name": "r", "fields": [{"name": "x", "type": "s"}]}', "Unknown Avro type 's'"),
        ('{"type": "record", "name": "r", "fields": [{"name": "x", "type": ["null", "r"]}]}', "holds itself"),
        ('{"name": "r"}', "Not an Avro type"),
    ],
)
def test_refused_declarations(text, message):
    with pytest.raises(ValueError, match=message):
        from_avro_text(text)


def test_refused_spark_types():
    for kind in (T.MapType(T.IntegerType(), T.StringType()), T.YearMonthIntervalType()):
        with pytest.raises(ValueError, match="Avro"):
            to_avro_text(T.StructType([T.StructField("x", kind)]))


def test_payloads_are_decoded(spark):
    text = json.dumps({"type": "record", "name": "r", "fields": PERSON["fields"][:3] + [PERSON["fields"][9]]})
    rows = [('{"id": 5, "name": null, "born": "2024-02-03", "home": {"town": "x"}}',), ("no json",)]
    df = spark.createDataFrame(rows, "data string")
    got = expand_payload(decode_payload(df, text)).collect()
    assert (got[0].id, got[0].name, str(got[0].born), got[0].home.town) == (5, None, "2024-02-03", "x")
    assert got[1].id is None
    flat = json.dumps({"type": "record", "name": "r", "fields": PERSON["fields"][:2]})
    (row,) = expand_payload(decode_payload(spark.createDataFrame([("7,z",)], "data string"), flat, "csv")).collect()
    assert tuple(row) == (7, "z")
