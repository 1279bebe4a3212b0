"""The four pipelines: file to topic, topic to topic (batch), decode and republish, topic to file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from topicflow.functions.payload import decode_payload, expand_payload
from topicflow.operators.delivery import Pull, finish, is_finished, pull_messages
from topicflow.operators.publish import publish, publish_once
from topicflow.options import SUBSCRIPTION_OPTIONS, Subscription, normalize, required
from topicflow.sources.files import stream_csv
from topicflow.storage import write_once
from topicflow.streaming.read import process_stream
from topicflow.streaming.write import write_stream_messages


def csv_to_topic(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """Publish the rows of new CSV files as row text (stream)."""
    return write_stream_messages(stream_csv(spark, path, schema, max_files=max_files), **options)


def topic_to_topic(
    spark: SparkSession, *, to_topic: str, as_text: bool = False, pull_id: str | None = None, **options
) -> Pull | None:
    """Forward one batch pull to another topic, then acknowledge it.

    Payload, attributes, publish time and id are kept. ``as_text=True`` publishes the text
    of the whole envelope in their place, under new ids. Safe to repeat under one ``pull_id``: the
    pull is pinned, the publish and the acknowledgement are done at most once. A pull that was
    forwarded before is not taken again, also after its lease is removed; None is returned then.
    """
    if pull_id is not None:
        known = {k: v for k, v in normalize(options).items() if k in SUBSCRIPTION_OPTIONS}
        if is_finished(spark, Subscription.of(known), pull_id):
            return None
    pull = pull_messages(spark, pull_id=pull_id, **options)
    target = {"root": pull.subscription.topic.root, "topic": to_topic, "publish_id": pull.pull_id}
    if as_text:
        wrote = publish_once(pull.messages, **target)
    else:
        wrote = publish_once(pull.stored, **target, **_AS_STORED)
    if pull.new and not wrote:
        raise RuntimeError(
            f"{to_topic!r} holds a publish {pull.pull_id!r} that is not of this pull; nothing was "
            "acknowledged, and the messages come again when their lease ends"
        )
    pull.ack()
    finish(pull)
    return pull


_AS_STORED = {
    "payload": "data",
    "attributes": "attributes",
    "publish_time": "publish_time",
    "message_id": "message_id",
}


def decode_republish(
    spark: SparkSession,
    schema: T.StructType | str,
    *,
    to_topic: str,
    fmt: str = "json",
    decode_options: dict[str, str] | None = None,
    **options,
) -> StreamingQuery:
    """Decode payloads to columns and publish those as row text to another topic (stream)."""
    root = required(normalize(options), "root")

    def forward(messages: DataFrame, offset: int) -> None:
        decoded = decode_payload(messages.select("data"), schema, fmt, options=decode_options)
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        publish(
            expand_payload(decoded), root=root, topic=to_topic, publish_id=f"{query_id}-{offset}"
        )

    return process_stream(spark, forward, **options)


def topic_to_csv(spark: SparkSession, path: str, **options) -> StreamingQuery:
    """Append the envelopes of a subscription to a CSV directory, payload as text (stream).

    Each micro-batch is one directory ``batch=<offset>`` that appears at once, and is
    acknowledged after that; a replay writes nothing. Options are those of ``process_stream``.
    """
    staging = f"{path.rstrip('/')}/_staging"

    def write(messages: DataFrame, offset: int) -> None:
        rows = messages.withColumn("data", F.col("data").cast("string"))
        write_once(rows, f"{path.rstrip('/')}/batch={offset}", staging, fmt="csv")

    return process_stream(spark, write, **options)
