"""Row text against what a JVM row prints, and payload decoding."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow import decode_payload, expand_payload, row_payload, row_text


def jvm_texts(df):
    """What the JVM prints for each row."""
    return [row.toString() for row in df._jdf.collect()]


def texts(df):
    return [r[0] for r in df.select(row_text(df)).collect()]


SCALARS = """
    select 1 as i, 2L as l, cast(3 as short) as s, cast(4 as byte) as y, 1.0E7D as d1,
      0.001D as d2, 1e-5D as d3, cast('NaN' as double) as nan, cast(1.5 as float) as f,
      1.50BD as dec, true as b, date'2024-01-02' as day, 'a,b]"' as text, 'grüße 漢字' as word,
      cast(null as string) as nothing, cast(null as int) as no_int
"""


def test_scalars_print_like_jvm_rows(spark):
    df = spark.sql(SCALARS)
    assert texts(df) == jvm_texts(df)


def test_all_null_row(spark):
    df = spark.sql(
        "select cast(null as int) a, cast(null as timestamp) t, cast(null as timestamp_ntz) n, "
        "cast(null as array<int>) x, cast(null as map<string,int>) m, "
        "cast(null as struct<a:int>) s, cast(null as decimal(20,10)) d, cast(null as binary) b"
    )
    assert texts(df) == ["[null,null,null,null,null,null,null,null]"] == jvm_texts(df)


MICROS = [0, 1, 7, 10, 120, 999, 1000, 7000, 120000, 500000, 999999, 999000, 123456]


@pytest.mark.parametrize("type_name", ["timestamp", "timestamp_ntz"])
def test_timestamps_print_like_jvm_rows(spark, type_name):
    if spark.sparkContext._jvm.java.util.TimeZone.getDefault().getRawOffset() != 0:
        pytest.skip("the JVM prints instants in its own zone")
    bases = [
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 3, 4, 0),
        datetime(2024, 1, 2),
        datetime(1965, 7, 8, 9, 10, 11),
    ]
    rows = [((b + timedelta(microseconds=m)).isoformat(),) for b in bases for m in MICROS]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast(type_name))
    assert texts(df) == jvm_texts(df)


@pytest.mark.parametrize("scale", [0, 2, 6, 7, 10, 18])
def test_decimals_print_like_jvm_rows(spark, scale):
    units = [0, 1, -1, 9, 10, -15, 99, 100, 123, 10**6, -(10**7), 123456789, 10**12 + 5]
    values = [(Decimal(u).scaleb(-scale),) for u in units]
    schema = T.StructType([T.StructField("d", T.DecimalType(30, scale))])
    df = spark.createDataFrame(values, schema)
    assert texts(df) == jvm_texts(df)


def test_structs_and_maps_print_like_jvm_rows(spark):
    df = spark.sql(
        """select named_struct('a', 1, 'b', named_struct('c', cast(null as string), 'd', 'x')) s,
             map('k', 1, 'j', null) m, map(1, named_struct('z', date'2020-02-03')) ms,
             named_struct('t', timestamp_ntz'2024-01-02 03:04:00') st"""
    )
    assert texts(df) == jvm_texts(df)


def test_arrays_print_wrapped(spark):
    df = spark.sql(
        "select array(1, null, 2) a, array(named_struct('x', 'y')) s, "
        "array(array(1), array()) n, cast(array() as array<int>) e"
    )
    expected = (
        "[WrappedArray(1, null, 2),WrappedArray([y]),"
        "WrappedArray(WrappedArray(1), WrappedArray()),WrappedArray()]"
    )
    assert texts(df) == [expected]
    assert texts(df) == [t.replace("ArraySeq", "WrappedArray") for t in jvm_texts(df)]


def test_binary_prints_its_text(spark):
    df = spark.createDataFrame([(bytearray("né,]".encode()),)], "b binary")
    assert texts(df) == ["[né,]]"]


def test_chosen_columns_and_odd_names(spark):
    df = spark.createDataFrame([(1, "x", 2)], "`a.b` int, `c``d` string, e int")
    assert df.select(row_text(df, ["c`d", "a.b"])).first()[0] == "[x,1]"
    assert texts(df) == ["[1,x,2]"]


def test_payload_is_utf8(spark):
    df = spark.createDataFrame([("grüße 漢字",)], "t string")
    assert bytes(df.select(row_payload(df)).first()[0]) == "[grüße 漢字]".encode()


def test_decode_and_expand_json(spark):
    bodies = ['{"a": 1, "b": "x"}', "not json", '{"a": 2}', None]
    rows = [(i, bytearray(b.encode()) if b else None) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "n int, data binary")
    out = expand_payload(decode_payload(df, "a bigint, b string"))
    assert out.columns == ["a", "b"]
    assert sorted(out.collect(), key=str) == sorted(
        [Row(a=1, b="x"), Row(a=2, b=None), Row(a=None, b=None), Row(a=None, b=None)], key=str
    )


def test_decode_takes_struct_type_and_csv(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(bytearray(b"7;z"),)], "data binary")
    out = expand_payload(decode_payload(df, schema, "csv", options={"sep": ";"}))
    assert out.collect() == [Row(a=7, b="z")]


def test_avro_without_module_says_what_to_add(spark):
    df = spark.createDataFrame([(bytearray(b"x"),)], "data binary")
    with pytest.raises(ValueError, match="spark-avro"):
        decode_payload(df, '{"type": "long"}', "avro")


def test_unknown_format(spark):
    df = spark.createDataFrame([(bytearray(b"x"),)], "data binary")
    with pytest.raises(ValueError, match="Unknown payload format"):
        decode_payload(df, "a int", "xml")


def test_intervals_are_iso_text(spark):
    """As a JVM period or duration prints them."""
    cases = {
        "interval '14' month": "P1Y2M", "interval '-14' month": "P-1Y-2M", "interval '2' year": "P2Y",
        "interval '0' month": "P0D", "interval '1 02:03:04.5' day to second": "PT26H3M4.5S",
        "interval '-1.5' second": "PT-1.5S", "interval '-0.000001' second": "PT-0.000001S",
        "interval '0' second": "PT0S", "interval '-3661' second": "PT-1H-1M-1S", "interval '90' minute": "PT1H30M",
        "interval '3' day": "PT72H", "cast(null as interval day to second)": "null",
    }
    df = spark.sql("select " + ", ".join(f"{c} as c{i}" for i, c in enumerate(cases)))
    assert df.select(row_text(df)).first()[0] == "[" + ",".join(cases.values()) + "]"
    nested = spark.sql("select array(interval '1' month, null) as a")
    assert nested.select(row_text(nested)).first()[0] == "[WrappedArray(P1M, null)]"
