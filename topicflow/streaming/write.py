"""Stream writes to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from topicflow.operators.publish import publish
from topicflow.options import TRIGGER_OPTIONS, check_output_mode, checked, required
from topicflow.streaming.control import with_trigger


def publish_batch(batch: DataFrame, batch_id: int, *, root: str, topic: str, **options) -> None:
    """Publish one micro-batch under ``<query id>-<batch id>``; a replay writes nothing.

    The query id is the one kept in the checkpoint. A query *name* would not do: with a new
    checkpoint batch ids start at 0 again, and fresh data would pass for a replay.
    """
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    publish(batch, root=root, topic=topic, publish_id=f"{query_id}-{batch_id}", **options)


def write_stream_messages(
    df: DataFrame,
    *,
    output_mode: str = "append",
    payload=None,
    attributes: str | None = None,
    publish_time: str | None = None,
    message_id: str | None = None,
    ids: str = "position",
    **options,
) -> StreamingQuery:
    """Publish every row of a streaming DataFrame, each micro-batch exactly once.

    Options: ``root``, ``topic``, ``checkpoint``, ``available_now`` or ``interval``,
    ``max_records_per_file``; the others are those of :func:`topicflow.to_messages`.
    """
    check_output_mode(output_mode)
    known = checked(options, "root", "topic", "max_records_per_file", *TRIGGER_OPTIONS)
    publish_options = {
        "root": required(known, "root"),
        "topic": required(known, "topic"),
        "payload": payload,
        "attributes": attributes,
        "publish_time": publish_time,
        "message_id": message_id,
        "ids": ids,
    }
    if "max_records_per_file" in known:
        publish_options["max_records_per_file"] = known["max_records_per_file"]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, batch_id, **publish_options)

    writer = df.writeStream.outputMode("append").foreachBatch(on_batch)
    return with_trigger(writer, known).start()
