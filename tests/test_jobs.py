from pathlib import Path

import pytest
from pyspark.sql import functions as F

from topicflow import Subscription, Topic, await_query, eligible, publish, read_topic
from topicflow.operators.maintenance import compact_acks, drop_expired_leases
from topicflow.plans.jobs import csv_to_topic, decode_republish, topic_to_csv, topic_to_topic


def payloads(spark, root, topic):
    rows = read_topic(spark, Topic(root, topic)).collect()
    return sorted(bytes(r.data).decode() for r in rows)


def test_csv_to_topic(spark, root, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("1,10\n2,20\n")
    options = {"root": root, "topic": "t", "checkpoint": f"{root}/cp", "available_now": True}
    assert await_query(csv_to_topic(spark, str(source), "orderId int, customerid int", **options), 120)
    (source / "b.csv").write_text("3,x\n")
    assert await_query(csv_to_topic(spark, str(source), "orderId int, customerid int", **options), 120)
    assert payloads(spark, root, "t") == ["[1,10]", "[2,20]", "[3,null]"]


def test_topic_to_topic_keeps_messages_and_repeats_safely(spark, root):
    df = spark.sql("select id, map('k', string(id)) a from range(20)")
    publish(
        df.withColumn("b", F.encode(F.lit("\x01é"), "UTF-8")),
        root=root, topic="from", payload="b", attributes="a", message_id="id",
    )
    options = {"root": root, "topic": "from", "subscription": "s", "max_messages": 15}
    for _ in range(2):
        topic_to_topic(spark, to_topic="to", pull_id="job", **options)
    columns = ["message_id", "data", "attributes", "publish_time"]
    moved = read_topic(spark, Topic(root, "to")).select(*columns)
    assert moved.count() == 15
    origin = {r.message_id: r for r in read_topic(spark, Topic(root, "from")).select(*columns).collect()}
    assert all(origin[r.message_id] == r for r in moved.collect())
    assert eligible(spark, Subscription.of(options)).count() == 5


def test_topic_to_topic_as_text(spark, root):
    df = spark.createDataFrame([("m", "hi")], "m string, b string")
    publish(df, root=root, topic="from", payload="b", message_id="m", as_of=7)
    topic_to_topic(
        spark, to_topic="to", as_text=True, as_of=9, root=root, topic="from", subscription="s"
    )
    assert payloads(spark, root, "to") == ["[s,-1,hi,7,9,{},m]"]


def test_decode_republish(spark, root):
    people = [('{"id": 1, "firstname": "Ann", "salary": null}',), ('{"id": 2}',), ("broken",)]
    publish(spark.createDataFrame(people, "j string"), root=root, topic="from", payload="j")
    query = decode_republish(
        spark, "id bigint, firstname string, salary bigint", to_topic="to",
        root=root, topic="from", subscription="s", checkpoint=f"{root}/cp", available_now=True,
    )
    assert await_query(query, 120)
    assert payloads(spark, root, "to") == ["[1,Ann,null]", "[2,null,null]", "[null,null,null]"]
    assert eligible(spark, Subscription.of({"root": root, "topic": "from", "subscription": "s"})).isEmpty()


def test_topic_to_csv(spark, root, tmp_path):
    bodies = ['a,"b"', "né", "two words"]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    publish(df, root=root, topic="t", payload="b", as_of=7)
    out = str(tmp_path / "out")
    query = topic_to_csv(
        spark, out, checkpoint=f"{root}/cp", available_now=True,
        root=root, topic="t", subscription="s",
    )
    assert await_query(query, 120)
    rows = spark.read.csv(out).collect()
    assert sorted(r[2] for r in rows) == sorted(bodies)
    assert {(r[0], r[1], r[3], r[5]) for r in rows} == {("s", "1", "7", "{}")}
    assert all(not p.read_text().startswith("subscription") for p in Path(out).rglob("*.csv"))
    assert eligible(spark, Subscription.of({"root": root, "topic": "t", "subscription": "s"})).isEmpty()


def test_topic_to_topic_repeated_after_upkeep(spark, root):
    """Neither lost nor doubled, whatever upkeep removed in between."""
    publish(spark.range(6), root=root, topic="from", publish_id="p")
    options = {"root": root, "topic": "from", "subscription": "s", "max_messages": 2}
    sub = Subscription.of(options | {"max_messages": None})
    topic_to_topic(spark, to_topic="to", pull_id="day1", as_of=5, **options)
    compact_acks(spark, sub)
    drop_expired_leases(spark, sub, keep_seconds=0)
    assert topic_to_topic(spark, to_topic="to", pull_id="day1", **options) is None
    assert read_topic(spark, Topic(root, "to")).count() == 2
    assert eligible(spark, sub).count() == 4


def test_topic_to_topic_does_not_acknowledge_what_it_did_not_forward(spark, root):
    publish(spark.range(6), root=root, topic="from", publish_id="p")
    publish(spark.range(1), root=root, topic="to", publish_id="day1")
    options = {"root": root, "topic": "from", "subscription": "s"}
    with pytest.raises(RuntimeError, match="nothing was acknowledged"):
        topic_to_topic(spark, to_topic="to", pull_id="day1", as_of=5, **options)
    assert eligible(spark, Subscription.of(options)).count() == 6
