"""Physical plans: what is scanned, what is shuffled, and that rows stay in the JVM."""

import re

import pytest
from pyspark.sql import functions as F

from topicflow import (
    Subscription,
    Topic,
    backlog,
    decode_payload,
    eligible,
    expand_payload,
    publish,
    pull_messages,
    read_topic,
    to_envelope,
    to_messages,
)
from topicflow.operators.delivery import ack_keys
from topicflow.operators import oldest as O
from topicflow.operators.state import Hidden, read_leases, waiting_files


def plan(df):
    """The physical plan, final if the frame has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return re.findall(r"ReadSchema: struct<([^\n]*?)>(?:\n|$|,)", text) or re.findall(
        r"ReadSchema: struct<(.*)>", text
    )


@pytest.fixture
def options(spark, root):
    for publish_id in ("a", "b"):
        df = spark.range(0, 100, 1, 2).select(
            F.concat(F.lit(publish_id), F.col("id")).alias("m"),
            F.timestamp_millis(F.col("id")).alias("t"),
        )
        publish(
            df, root=root, topic="t", publish_id=publish_id,
            payload="m", message_id="m", publish_time="t",
        )
    return {"root": root, "topic": "t", "subscription": "s"}


def test_publish_by_position_does_not_shuffle(spark):
    text = plan(to_messages(spark.range(100), "p"))
    assert "Exchange" not in text and "Python" not in text


def test_content_ids_count_before_the_shuffle(spark):
    text = plan(to_messages(spark.range(100).selectExpr("id % 3 as k"), "p", ids="content"))
    assert "partial_count" in text and "Window" not in text and "Python" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_conversions_run_in_the_jvm_without_shuffle(spark, options):
    messages = read_topic(spark, Topic(options["root"], "t"))
    for df in (to_envelope(messages, "s"), expand_payload(decode_payload(messages, "a int"))):
        text = plan(df)
        assert "Exchange" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(spark, options):
    messages = read_topic(spark, Topic(options["root"], "t"))
    text = plan(
        messages.where("publish_id = 'a' and publish_time > timestamp'2024-01-01'").select("message_id")
    )
    assert "PartitionFilters: [isnotnull(publish_id" in text
    assert "GreaterThan(publish_time," in text
    assert "data:binary" not in text


def test_publish_times_have_statistics(spark, options):
    import pyarrow.parquet as pq

    path = read_topic(spark, Topic(options["root"], "t")).select(F.input_file_name()).first()[0]
    group = pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0)
    times = next(
        group.column(i) for i in range(group.num_columns)
        if group.column(i).path_in_schema == "publish_time"
    )
    assert times.statistics is not None and times.statistics.has_min_max


def test_choosing_what_to_pull_reads_no_payload(spark, options):
    sub = Subscription.of(options)
    pull_messages(spark, **options).ack()
    files = plan(waiting_files(spark, sub, 0))
    assert "first_micros" in files and "publish_time" not in files
    text = plan(eligible(spark, sub, 10**15).select("publish_time", "message_id", "publish_id"))
    assert "data:binary" not in text and "attributes" not in text
    assert "data:binary" not in plan(backlog(spark, sub))


def test_no_rows_of_a_large_pull_are_gathered_by_a_limit(spark, options, monkeypatch):
    monkeypatch.setattr(O, "FEW", 100)
    keys, _ = O.oldest(spark, Subscription.of(options), 150, 10**15)
    assert keys.count() == 150 and "TakeOrdered" not in plan(keys) and "Limit" not in plan(keys)


def test_acks_and_leases_are_one_join(spark, options):
    sub = Subscription.of(options)
    pull_messages(spark, **options).ack()
    text = plan(eligible(spark, sub, 0).select("message_id"))
    assert text.count("LeftOuter") == 1 and "LeftAnti" not in text


def test_acks_of_other_publishes_are_pruned(spark, options):
    sub = Subscription.of(options)
    ack_keys(read_topic(spark, sub.topic, positions=True).where("message_id like '%7'"), sub, ack_id="x")
    text = plan(Hidden.of(spark, sub, None).masks(["a"]))
    assert re.search(r"PartitionFilters: \[[^]]*publish_id#\d+ (=|IN)", text)


def test_large_ack_tables_are_not_broadcast(spark, options):
    sub = Subscription.of(options)
    keys = read_topic(spark, sub.topic, positions=True).where("message_id not like '%7'")
    ack_keys(keys, sub, ack_id="x")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = eligible(spark, sub, 0).select("message_id")
        assert df.count() == 20
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_expired_leases_are_not_listed(spark, options):
    sub = Subscription.of(options)
    pull_messages(spark, as_of=1000, **options)
    pull_messages(spark, as_of=10**13, **options)
    assert [f for f in read_leases(spark, sub).inputFiles() if "lease_until=241000" in f]
    assert not [f for f in read_leases(spark, sub, 10**12).inputFiles() if "lease_until=241000" in f]


def test_a_pull_opens_only_the_files_it_needs(spark, options):
    pull = pull_messages(spark, max_messages=3, **options)
    opened = {f for f in pull.stored.inputFiles() if "/topics/" in f}
    everything = read_topic(spark, Topic(options["root"], "t")).inputFiles()
    assert pull.stored.count() == 3 and len(opened) == 2 < len(everything) == 4
