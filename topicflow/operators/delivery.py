"""Pull, lease and acknowledge."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.functions.envelope import to_envelope
from topicflow.operators import oldest
from topicflow.options import (
    DEFAULT_LEASE_SECONDS,
    DEFAULT_MAX_MESSAGES,
    SUBSCRIPTION_OPTIONS,
    Subscription,
    checked,
    checked_name,
    positive,
    to_millis,
)
from topicflow.operators.state import Files, bind, check_bound, has_backlog, merged_ranges, ranges_of
from topicflow.schema import FILE_KEY, KEY, LEASE_SCHEMA, ROWS
from topicflow.storage import delete, exists, find, list_dirs, make_dirs, write_once

#: Seconds between two looks of a pull that waits: at first, and at most.
FIRST_LOOK, LAST_LOOK = 0.1, 5.0


@dataclass(frozen=True)
class Pull:
    """A pinned set of leased messages: reading it again gives the same rows."""

    spark: SparkSession
    subscription: Subscription
    pull_id: str
    path: str
    as_of: int
    #: Whether this call chose the messages; False if the pull was held before.
    new: bool = True

    @property
    def leased(self) -> DataFrame:
        """The lease rows of this pull."""
        return _lease_rows(self.spark, self.subscription, self.path)

    @property
    def stored(self) -> DataFrame:
        """The pulled messages with the columns of the topic table."""
        return _pinned(self.subscription, self.leased)

    @property
    def messages(self) -> DataFrame:
        """The pulled messages as envelopes."""
        return to_envelope(self.stored, self.subscription.name, as_of=self.as_of)

    def ack(self, acked_at: datetime | int | None = None) -> None:
        """Acknowledge exactly the messages of this pull."""
        ack_pull(self.spark, self.subscription, self.pull_id, acked_at)

    def modify_lease(
        self, lease_seconds: int, *, where: Column | str | None = None, as_of: datetime | int | None = None
    ) -> None:
        """Set a new deadline, ``as_of + lease_seconds``, for the messages of this pull, or for those whose
        lease rows fulfil ``where``. 0 gives them back at once."""
        modify_lease(self.spark, self.subscription, self.pull_id, lease_seconds, where=where, as_of=as_of)


def _lease_rows(spark: SparkSession, sub: Subscription, path: str) -> DataFrame:
    return spark.read.schema(LEASE_SCHEMA).option("basePath", sub.leases).parquet(path)


def _held(spark: SparkSession, sub: Subscription, pull_id: str) -> str | None:
    """The directory of the lease taken under a pull id."""
    name = f"pull_id={checked_name('pull_id', pull_id)}"
    held = find(spark, f"{sub.leases}/claim=*/lease_until=*/{name}")
    return held[0] if held else None


def _pinned(sub: Subscription, keys: DataFrame) -> DataFrame:
    """Full messages for a set of keys. Only the files that hold them are listed and read."""
    spark = keys.sparkSession
    messages = Files.of(keys.select(*FILE_KEY).distinct()).messages(spark, sub)
    columns = [c for c in messages.columns if c not in ("file_name", "position")]
    return messages.join(keys.select(*KEY), KEY, "left_semi").select(*columns)


def _next_claim(spark: SparkSession, sub: Subscription) -> int:
    """The number that the next lease on the subscription has."""
    return max((int(n.removeprefix("claim=")) for n in list_dirs(spark, sub.leases)), default=0) + 1


def _claim(sub: Subscription, keys: DataFrame, claim: int, pull_id: str, until: int) -> str | None:
    """Write the lease with a number; None, and nothing is written, if another lease has that number."""
    inside = f"lease_until={until}/pull_id={checked_name('pull_id', pull_id)}"
    rows = keys.select(F.lit(sub.name).alias("subscription"), *KEY, "message_id")
    target = f"{sub.leases}/claim={claim}"
    wrote = write_once(rows, target, sub.staging, sort_by=KEY, inside=inside)
    return f"{target}/{inside}" if wrote else None


def lease(
    spark: SparkSession,
    sub: Subscription,
    keys: DataFrame,
    *,
    pull_id: str,
    lease_seconds: int = DEFAULT_LEASE_SECONDS,
    as_of: datetime | int | None = None,
) -> str:
    """Hide messages until ``as_of + lease_seconds``; returns the directory of the lease.

    ``keys`` needs ``publish_id``, ``file_name``, ``position`` and ``message_id``. A ``pull_id``
    that holds a lease keeps it as it is; see :func:`modify_lease`.
    """
    bind(spark, sub)
    until = to_millis(as_of) + 1000 * int(lease_seconds)
    while True:
        if held := _held(spark, sub, pull_id):
            return held
        if path := _claim(sub, keys, _next_claim(spark, sub), pull_id, until):
            return path


def modify_lease(
    spark: SparkSession,
    sub: Subscription,
    pull_id: str,
    lease_seconds: int,
    *,
    where: Column | str | None = None,
    as_of: datetime | int | None = None,
) -> None:
    """Set a new deadline, ``as_of + lease_seconds``, for messages that are out: shorter or longer, 0 gives
    them back at once.

    ``where`` is a condition on the lease rows (``message_id``, ``publish_id``, ...); without it all messages of
    the pull are meant. Changes are numbered, and a message has the deadline of the latest one. Messages
    that were acknowledged stay so.
    """
    held = _held(spark, sub, pull_id)
    if not held:
        raise ValueError(f"No pull {pull_id!r} on subscription {sub.name!r}")
    if int(lease_seconds) < 0:
        raise ValueError(f"A lease of {lease_seconds} seconds")
    rows = _lease_rows(spark, sub, held)
    rows = rows.where(where) if where is not None else rows
    until = to_millis(as_of) + 1000 * int(lease_seconds)
    path = f"{sub.deadlines}/pull_id={pull_id}"
    while True:
        taken = list_dirs(spark, path)
        number = max((int(n.removeprefix("sequence=")) for n in taken), default=0) + 1
        inside = f"lease_until={until}"
        if write_once(rows.select(*KEY), f"{path}/sequence={number}", sub.staging, sort_by=KEY, inside=inside):
            return


def pull_messages(
    spark: SparkSession,
    *,
    pull_id: str | None = None,
    as_of: datetime | int | None = None,
    **options,
) -> Pull:
    """Take the oldest ``max_messages`` eligible messages and hide them for ``lease_seconds``.

    ``max_bytes`` bounds their payloads in all; the first message is taken whatever its size. With
    ``wait_seconds`` a pull that finds nothing looks again, less and less often, until a message
    waits or the time is over.

    The keys are written as lease rows first; what is returned reads that pinned set, never
    the open-ended query behind it. Calling again with the same ``pull_id`` returns the same
    set. Leases are numbered: of two pullers that chose at once, one finds its number taken and chooses
    again, so no message is in both pulls.

    To move much more than some thousand messages use a stream: it works by whole files and
    needs no sort and no join.
    """
    known = checked(options, *SUBSCRIPTION_OPTIONS, "max_messages", "max_bytes", "lease_seconds", "wait_seconds")
    sub = Subscription.of(known)
    n = positive("max_messages", known.get("max_messages", DEFAULT_MAX_MESSAGES))
    max_bytes = positive("max_bytes", known["max_bytes"]) if known.get("max_bytes") is not None else None
    seconds = int(known.get("lease_seconds", DEFAULT_LEASE_SECONDS))
    pull_id = pull_id or uuid.uuid4().hex
    check_bound(spark, sub)
    if held := _held(spark, sub, pull_id):
        return Pull(spark, sub, pull_id, held, to_millis(as_of), new=False)
    wait_for_messages(spark, sub, float(known.get("wait_seconds", 0)), as_of)
    bind(spark, sub)
    while True:
        now, claim = to_millis(as_of), _next_claim(spark, sub)
        chosen, scratch = oldest.oldest(spark, sub, n, now, max_bytes)
        path = _claim(sub, chosen, claim, pull_id, now + 1000 * seconds)
        delete(spark, scratch)
        if path:
            return Pull(spark, sub, pull_id, path, now)
        if held := _held(spark, sub, pull_id):
            return Pull(spark, sub, pull_id, held, now, new=False)


def wait_for_messages(
    spark: SparkSession, sub: Subscription, seconds: float, as_of: datetime | int | None = None
) -> bool:
    """Wait until a message waits, for ``seconds`` at most; False if none came.

    Between looks nothing runs. A look lists the publishes, and asks for a backlog only if there
    is a new one, or a lease may have ended.
    """
    end, pause, seen = time.monotonic() + seconds, FIRST_LOOK, None
    while seconds > 0:
        leased = bool(list_dirs(spark, sub.leases))
        publishes = list_dirs(spark, sub.topic.path)
        if (leased or publishes != seen) and has_backlog(spark, sub, as_of):
            return True
        seen = publishes
        left = end - time.monotonic()
        if left <= 0:
            return False
        time.sleep(min(pause, left))
        pause = min(2 * pause, LAST_LOOK)
    return False


def finish(pull: Pull) -> None:
    """Record for good that a pull's work is done, whatever upkeep removes later."""
    make_dirs(pull.spark, pull.subscription.finished(pull.pull_id))


def is_finished(spark: SparkSession, sub: Subscription, pull_id: str) -> bool:
    return exists(spark, sub.finished(pull_id))


def ack_pull(
    spark: SparkSession, sub: Subscription, pull_id: str, acked_at: datetime | int | None = None
) -> None:
    """Acknowledge the messages leased under ``pull_id``. Repeating it changes nothing."""
    held = _held(spark, sub, pull_id)
    if not held:
        raise ValueError(f"No pull {pull_id!r} on subscription {sub.name!r}")
    ack_keys(_lease_rows(spark, sub, held), sub, ack_id=pull_id, acked_at=acked_at)


def ack_keys(
    keys: DataFrame, sub: Subscription, *, ack_id: str, acked_at: datetime | int | None = None
) -> None:
    """Acknowledge the messages named by ``publish_id``, ``file_name`` and ``position``, stored as the
    fewest ranges."""
    _write_ranges(ranges_of(keys), sub, ack_id, acked_at)


def ack_ranges(
    ranges: DataFrame, sub: Subscription, *, ack_id: str, acked_at: datetime | int | None = None
) -> None:
    """Acknowledge the rows ``from_row`` to before ``to_row`` of the files named by ``publish_id`` and
    ``file_name``. Ranges may overlap."""
    _write_ranges(merged_ranges(ranges), sub, ack_id, acked_at)


def _write_ranges(ranges: DataFrame, sub: Subscription, ack_id: str, acked_at: datetime | int | None) -> None:
    bind(ranges.sparkSession, sub)
    rows = ranges.select(
        F.lit(sub.name).alias("subscription"),
        *ROWS,
        F.lit(to_millis(acked_at)).cast("long").alias("acked_at"),
    )
    path = f"{sub.acks}/ack_id={checked_name('ack_id', ack_id)}"
    write_once(rows, path, sub.staging, sort_by=ROWS, partition_by=["publish_id"])


def ack_files(files: DataFrame, sub: Subscription, *, ack_id: str) -> None:
    """Acknowledge every message of the files named by ``publish_id`` and ``file_name``."""
    bind(files.sparkSession, sub)
    rows = files.select(
        F.lit(sub.name).alias("subscription"),
        *FILE_KEY,
        F.lit(to_millis(None)).cast("long").alias("acked_at"),
    )
    path = f"{sub.file_acks}/ack_id={checked_name('ack_id', ack_id)}"
    write_once(rows, path, sub.staging, sort_by=["publish_id"], partition_by=["publish_id"])


def read_messages(
    spark: SparkSession,
    *,
    ack: str = "none",
    as_of: datetime | int | None = None,
    **options,
) -> DataFrame:
    """The oldest ``max_messages`` eligible messages as envelopes.

    ``ack="none"`` only looks: no state changes. ``ack="on_read"`` acknowledges them before
    they are returned; the frame stays readable, since it reads a pinned set. To
    acknowledge after success use :func:`pull_messages`.
    """
    if ack == "on_read":
        pull = pull_messages(spark, as_of=as_of, **options)
        pull.ack(as_of)
        return pull.messages
    if ack != "none":
        raise ValueError(f"ack must be 'none' or 'on_read', not {ack!r}")
    known = checked(options, *SUBSCRIPTION_OPTIONS, "max_messages", "max_bytes")
    sub = Subscription.of(known)
    n = positive("max_messages", known.get("max_messages", DEFAULT_MAX_MESSAGES))
    max_bytes = positive("max_bytes", known["max_bytes"]) if known.get("max_bytes") is not None else None
    now = to_millis(as_of)
    keys, scratch = oldest.oldest(spark, sub, n, now, max_bytes)
    rows = keys.select(*KEY).toArrow()  # at most the n messages that the caller asked to look at
    delete(spark, scratch)
    return to_envelope(_pinned(sub, spark.createDataFrame(rows)), sub.name, as_of=now)
