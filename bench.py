"""Headline timings at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow import (
    Subscription,
    Topic,
    await_query,
    backlog,
    decode_payload,
    expand_payload,
    process_stream,
    publish,
    pull_messages,
    read_topic,
    write_stream_messages,
)
from topicflow.operators.delivery import ack_files, ack_keys
from topicflow.sources.topic import read_files

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("topicflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every row and column, and keep none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    root = tempfile.mkdtemp(prefix="bench-")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    rows = {"events": events.count(), "orders": orders.count(), "lineitem": lineitem.count(), "many": 100_000}

    messages = events.select(
        F.col("event_id").cast("string").alias("id"),
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("body"),
        F.from_json("props", "map<string,string>").alias("attrs"),
        "ts",
    )
    publish(
        messages, root=root, topic="ev", publish_id="all",
        payload="body", attributes="attrs", publish_time="ts", message_id="id",
    )
    topic = Topic(root, "ev")
    half = {"root": root, "topic": "ev", "subscription": "half"}
    stored = read_topic(spark, topic, positions=True).drop("data")
    ack_keys(stored.where(F.crc32("message_id") % 2 == 0), Subscription.of(half), ack_id="half")

    many = {"root": root, "topic": "many", "subscription": "most-acked"}
    publish(spark.range(0, 100_000, 1, 1000), root=root, topic="many", publish_id="all")
    files = read_files(spark, Topic(root, "many")).orderBy("file_name").limit(990)
    ack_files(files.select("publish_id", "file_name"), Subscription.of(many), ack_id="most")

    def new(prefix: str) -> str:
        return f"{prefix}-{uuid.uuid4().hex}"

    def pull() -> None:
        drain(pull_messages(spark, max_messages=100, lease_seconds=0, **half).messages)

    def pull_large() -> None:
        whole = {"root": root, "topic": "ev", "subscription": new("large")}
        drain(pull_messages(spark, max_messages=rows["events"] // 2, **whole).messages)

    def pull_many() -> None:
        drain(pull_messages(spark, max_messages=10, lease_seconds=0, **many).messages)

    def stream_pull() -> None:
        name = new("sub")
        query = process_stream(
            spark, lambda df, _: drain(df), available_now=True,
            root=root, topic="ev", subscription=name, checkpoint=f"{root}/{name}",
        )
        await_query(query, 600)

    def stream_publish() -> None:
        name = new("to")
        files = spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet")
        query = write_stream_messages(
            files.parquet(SF_DIR), root=root, topic=name, checkpoint=f"{root}/{name}",
            available_now=True,
        )
        await_query(query, 600)

    def decode() -> None:
        fields = "event_id bigint, user_id bigint, event_type string, value double"
        drain(expand_payload(decode_payload(read_topic(spark, topic), fields)))

    work: dict[str, tuple[Callable[[], object], str]] = {
        "publish_orders": (lambda: publish(orders, root=root, topic=new("o")), "orders"),
        "publish_lineitem": (lambda: publish(lineitem, root=root, topic=new("l")), "lineitem"),
        "publish_content_ids": (
            lambda: publish(orders, root=root, topic=new("c"), ids="content"),
            "orders",
        ),
        "pull_half_acked": (pull, "events"),
        "backlog_half_acked": (lambda: backlog(spark, Subscription.of(half)).collect(), "events"),
        "decode_json": (decode, "events"),
        "pull_half_of_events": (pull_large, "events"),
        "pull_10_of_1000_files_990_acked": (pull_many, "many"),
        "backlog_1000_files_990_acked": (lambda: backlog(spark, Subscription.of(many)).collect(), "many"),
        "stream_pull": (stream_pull, "events"),
        "stream_publish": (stream_publish, "orders"),
    }
    seconds, rate = {}, {}
    for name, (run, table) in work.items():
        run()  # warm-up
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        rate[name] = round(rows[table] / seconds[name])
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_second": rate,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
