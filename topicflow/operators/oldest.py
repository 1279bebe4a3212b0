"""Which messages a pull takes: the oldest that wait, found without sorting the topic."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.operators import prefix
from topicflow.operators.state import Files, Hidden, at_most, waiting_files, waiting_messages
from topicflow.options import Subscription
from topicflow.schema import FILE_KEY, KEY

#: Oldest first. Ties follow the stored order, so that the oldest messages lie in few files.
ORDER = ["publish_time", *KEY]
#: Up to so many messages are sorted in one place; more are dealt by ranges.
FEW = 10_000


def cut_files(files: DataFrame, n: int, scratch: str) -> tuple[Files, int | None]:
    """The files to look into, and a publish time before or at which ``n`` messages wait (None if fewer
    wait in all).

    Files are taken in the order of their last message until they hold enough; then those that
    begin later are left out. The driver cuts a list of at most ``FILES_AT_ONCE``; a longer one is summed by
    ranges, written to ``scratch``.
    """
    rows = at_most(files)
    if rows is not None:
        held, end = 0, None
        for r in sorted(rows, key=lambda r: (r.last_micros, r.publish_id, r.file_name)):
            held += r.waiting
            if held >= n:
                end = r.last_micros
                break
        return Files(None, [r for r in rows if end is None or r.first_micros <= end]), end
    columns = [*FILE_KEY, "first_micros", "last_micros", "waiting"]
    place = prefix.reaches(files.select(*columns), ["last_micros", *FILE_KEY], "waiting", n, scratch)
    ranged = files.sparkSession.read.parquet(scratch)
    if place is None:
        return Files.of(ranged), None
    return Files.of(ranged.where(F.col("first_micros") <= place["last_micros"])), place["last_micros"]


def oldest(
    spark: SparkSession, sub: Subscription, n: int, now: int, max_bytes: int | None = None
) -> tuple[DataFrame, str]:
    """Keys (with ``message_id``) of the ``n`` oldest waiting messages, or of all if fewer wait; of these
    the first ones whose payloads are ``max_bytes`` in all, one at least.

    Only files that begin before the end that ``cut_files`` finds are opened, and of their messages only those up
    to it are looked at. A small number is taken by a top-n. For a large one, or a bound of bytes, keys are
    written range-partitioned and cut by sums a range: no two keys are equal, so ranges are even, and no
    task gathers ``n`` rows. Also returns a directory for the caller to remove, when the keys were used.
    """
    scratch = f"{sub.staging}/{uuid.uuid4().hex}"
    hidden = Hidden.of(spark, sub, now)
    files, end = cut_files(waiting_files(spark, sub, now, hidden), n, f"{scratch}/files")
    messages = waiting_messages(spark, sub, files, hidden)
    if end is not None:
        messages = messages.where(F.col("publish_time") <= F.timestamp_micros(F.lit(end)))
    if max_bytes is None and n <= FEW:
        return messages.select(*ORDER, "message_id").orderBy(*ORDER).limit(n), scratch
    measures = {"_messages": F.lit(1).cast("long")}
    bounds = {"_messages": n}
    if max_bytes is not None:
        measures["_bytes"] = F.coalesce(F.octet_length("data"), F.lit(0)).cast("long")
        bounds["_bytes"] = max_bytes
    rows = messages.select(*ORDER, "message_id", *(c.alias(m) for m, c in measures.items()))
    if n <= FEW:
        rows = rows.orderBy(*ORDER).limit(n)
    return prefix.up_to(rows, ORDER, bounds, f"{scratch}/keys").drop(*measures), scratch
