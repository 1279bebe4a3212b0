from datetime import datetime

import pytest
from pyspark.sql import functions as F

from topicflow import ENVELOPE_SCHEMA, attributes_text, to_envelope
from topicflow.functions.envelope import utc_timestamp
from topicflow.schema import TOPIC_SCHEMA


@pytest.mark.parametrize(
    ("attributes", "text"),
    [
        ("map()", "{}"),
        ("null", "{}"),
        ("map('k', '69')", "{k=69}"),
        ("map('k', 'v', 'k2', 'v2')", "{k=v, k2=v2}"),
        ("map('k', 'a=b, c')", "{k=a=b, c}"),
    ],
)
def test_attributes_text(spark, attributes, text):
    df = spark.sql(f"select cast({attributes} as map<string,string>) as a")
    assert df.select(attributes_text(F.col("a"))).first()[0] == text


@pytest.mark.parametrize(
    ("text", "millis"),
    [
        ("1970-01-01T00:00:00.001999Z", 1),
        ("2024-01-02T03:04:05.678901Z", 1704164645678),
        ("1969-12-31T23:59:59.999999Z", -1),
        ("1960-01-01T00:00:00Z", -315619200000),
    ],
)
def test_publish_time_is_floored_to_millis(spark, text, millis):
    df = spark.createDataFrame([("m", bytearray(b"x"), {}, text)], "m string, d binary, a map<string,string>, t string")
    stored = df.select(
        F.col("m").alias("message_id"),
        F.col("d").alias("data"),
        F.col("a").alias("attributes"),
        F.col("t").cast("timestamp").alias("publish_time"),
    )
    row = to_envelope(stored, "s", as_of=5).first()
    assert row.publish_timestamp == millis
    assert (row.subscription, row.offset, row.event_timestamp) == ("s", -1, 5)


def test_columns_and_types(spark):
    stored = spark.createDataFrame([], TOPIC_SCHEMA)
    envelope = to_envelope(stored, "s")
    assert [(f.name, f.dataType) for f in envelope.schema] == [
        (f.name, f.dataType) for f in ENVELOPE_SCHEMA
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_local_timestamps_are_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select timestamp_ntz'2024-01-02 03:04:05.678' as t")
        got = df.select(F.unix_millis(utc_timestamp(F.col("t"), "timestamp_ntz"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == 1704164645678
    assert datetime.fromtimestamp(got / 1000).year == 2024


def test_local_time_inside_a_clock_gap(spark):
    """02:30 does not exist in New York on that day; it is 02:30 UTC all the same."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.123' as t")
        got = df.select(F.unix_millis(utc_timestamp(F.col("t"), "timestamp_ntz"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == 1_710_037_800_123
