"""Rows to messages, appended to a topic by executors."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.functions.envelope import utc_timestamp
from topicflow.functions.payload import quoted, row_payload
from topicflow.options import (
    DEFAULT_MAX_RECORDS_PER_FILE,
    FILE_TABLE,
    Topic,
    check_save_mode,
    checked_name,
    positive,
    to_millis,
)
from topicflow.sources.topic import file_rows
from topicflow.storage import write_once

#: Copies of one message that are numbered together; all its copies are cut into such blocks.
BLOCK_OF_COPIES = 100_000

STORED = ["message_id", "data", "attributes", "publish_time"]


def _payload_column(df: DataFrame, payload: str | Sequence[str] | None) -> Column:
    if isinstance(payload, str):
        data_type = df.schema[payload].dataType
        if not isinstance(data_type, T.BinaryType | T.StringType):
            raise ValueError(f"Payload column {payload!r} must be binary or string; use [{payload!r}]")
        return quoted(payload).cast("binary")
    return row_payload(df, payload)


def to_messages(
    df: DataFrame,
    publish_id: str,
    *,
    payload: str | Sequence[str] | None = None,
    attributes: str | None = None,
    publish_time: str | None = None,
    message_id: str | None = None,
    as_of: datetime | int | None = None,
    ids: str = "position",
) -> DataFrame:
    """One message per row, as the stored columns.

    ``payload``: None takes the text of the whole row, a list of columns the text of those,
    one column name its bytes or UTF-8 text. ``attributes`` names a map column,
    ``publish_time`` a timestamp column (where missing: ``as_of``, else the clock of the
    query), ``message_id`` a string column.

    Without ``message_id``, ``ids="position"`` numbers rows where they stand, with no
    shuffle. ``ids="content"`` derives the id from the message itself, so that publishing
    the same rows again under the same ``publish_id`` gives the same ids; it costs a shuffle
    of the messages.
    """
    clock = F.current_timestamp() if as_of is None else F.timestamp_millis(F.lit(to_millis(as_of)))
    if publish_time is None:
        time = clock
    else:
        given = utc_timestamp(quoted(publish_time), df.schema[publish_time].dataType.typeName())
        time = F.coalesce(given, clock)
    no_attributes = F.create_map().cast("map<string,string>")
    messages = [
        _payload_column(df, payload).alias("data"),
        (quoted(attributes) if attributes else no_attributes).alias("attributes"),
        time.alias("publish_time"),
    ]
    if message_id is not None:
        stored = df.select(quoted(message_id).cast("string").alias("message_id"), *messages)
    elif ids == "position":
        position = F.lpad(F.lower(F.hex(F.monotonically_increasing_id())), 16, "0")
        stored = df.select(
            F.concat(F.lit(f"{publish_id}-"), position).alias("message_id"), *messages
        )
    elif ids == "content":
        stored = _number_copies(df.select(*messages), publish_id, publish_time is not None)
    else:
        raise ValueError(f"ids must be 'position' or 'content', not {ids!r}")
    return stored.select(*STORED)


def _number_copies(messages: DataFrame, publish_id: str, timed: bool) -> DataFrame:
    """Ids that depend on content only: a hash of the message and the number of its copy.

    Equal messages are counted, with a partial count before the shuffle, and written out
    again with copy numbers. Counts are cut into blocks that are spread over the cluster, so no
    task ever holds the copies of one message. A clock value differs on replay, so a stamped
    publish time stays out of the key and the hash.
    """
    entries = F.array_sort(F.map_entries("attributes"))
    key = ["data", "entries", "publish_time"] if timed else ["data", "entries"]
    stamp = F.first("publish_time", ignorenulls=True).alias("publish_time")
    copies = F.count(F.lit(1)).alias("copies")
    counted = (
        messages.withColumn("entries", entries)
        .groupBy(*key)
        .agg(*([copies] if timed else [copies, stamp]))
        .withColumn("digest", _digest(publish_id, timed))
    )

    one = F.lit(1).cast("long")
    starts = F.sequence(one, F.col("copies"), F.lit(BLOCK_OF_COPIES).cast("long"))
    blocks = counted.select("*", F.explode(starts).alias("from_copy")).repartition("digest", "from_copy")
    last = F.least(F.col("copies"), F.col("from_copy") + (BLOCK_OF_COPIES - 1))
    numbered = blocks.select("*", F.explode(F.sequence("from_copy", last)).alias("copy"))
    return numbered.select(
        F.concat_ws("-", "digest", "copy").alias("message_id"),
        "data",
        F.map_from_entries("entries").alias("attributes"),
        "publish_time",
    )


def _digest(publish_id: str, timed: bool) -> Column:
    """SHA-256 of a message in its publish. The lengths in front keep the parts apart."""
    entries = F.array_join(F.transform("entries", lambda e: F.to_json(e)), ",")
    time = [F.unix_micros("publish_time").cast("string")] if timed else []
    size = F.coalesce(F.octet_length("data").cast("string"), F.lit("none"))
    lengths = F.octet_length(entries).cast("string")
    head = F.concat_ws("|", F.lit(publish_id), *time, size, lengths, entries)
    data = F.coalesce(F.col("data"), F.lit("").cast("binary"))
    return F.sha2(F.concat(head.cast("binary"), data), 256)


def publish(
    df: DataFrame,
    *,
    root: str,
    topic: str,
    publish_id: str | None = None,
    mode: str = "append",
    max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
    **message_options,
) -> DataFrame:
    """Append every row of ``df`` to the topic as one message; returns ``df``.

    The rows of one call become visible together. ``publish_id`` names the call: a second
    one with the same id writes nothing, so a retried job does not publish twice. Without
    it every call publishes. See :func:`to_messages` for ``message_options``.
    """
    publish_once(
        df, root=root, topic=topic, publish_id=publish_id, mode=mode,
        max_records_per_file=max_records_per_file, **message_options,
    )
    return df


def publish_once(
    df: DataFrame,
    *,
    root: str,
    topic: str,
    publish_id: str | None = None,
    mode: str = "append",
    max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
    **message_options,
) -> bool:
    """:func:`publish`, telling whether it wrote: False if ``publish_id`` was published before."""
    check_save_mode(mode)
    target = Topic.of({"root": root, "topic": topic})
    publish_id = checked_name("publish_id", publish_id or uuid.uuid4().hex)
    return write_once(
        to_messages(df, publish_id, **message_options),
        target.publish_path(publish_id),
        target.staging,
        max_records_per_file=positive("max_records_per_file", max_records_per_file),
        beside=(FILE_TABLE, lambda staged: file_rows(staged, publish_id)),
    )
