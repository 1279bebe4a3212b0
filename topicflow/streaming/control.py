"""Triggers, waiting, and a readable error for a checkpoint that no longer fits."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from topicflow.options import required

# What Spark says when a checkpoint does not belong to the query, or files it
# names are gone.
STALE_CHECKPOINT_SIGNS = (
    "Positive number of partitions required",
    "sources in the checkpoint offsets",
    "FAILED_READ_FILE.FILE_NOT_EXIST",
)


class StaleCheckpointError(RuntimeError):
    """The checkpoint belongs to another query or to data that is gone."""


def with_trigger(writer: DataStreamWriter, options: Mapping[str, Any]) -> DataStreamWriter:
    """Sets the checkpoint, and the trigger: ``available_now`` takes everything that waits
    and then stops, ``interval`` repeats, and without either batches follow each other."""
    available_now = str(options.get("available_now", False)).lower() == "true"
    interval = options.get("interval")
    if available_now and interval:
        raise ValueError("Give available_now or interval, not both")
    writer = writer.option("checkpointLocation", required(options, "checkpoint"))
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def await_query(query: StreamingQuery, timeout: int | None = None, checkpoint: str = "") -> bool:
    """Wait for a query; False if it still runs after ``timeout`` seconds."""
    try:
        return query.awaitTermination(timeout) if timeout else query.awaitTermination() or True
    except StreamingQueryException as error:
        if any(sign in str(error) for sign in STALE_CHECKPOINT_SIGNS):
            raise StaleCheckpointError(
                f"The query cannot go on from its checkpoint {checkpoint}: it belongs to "
                "another query, or its files are gone. Give a new checkpoint path, or bring "
                f"the files back. Spark said: {error}"
            ) from error
        raise
