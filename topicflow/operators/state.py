"""Delivery state as tables, and the messages it leaves to deliver.

State is plain Parquet next to the topic. Every write is one new directory made visible by
one rename, so a repeated call changes nothing and readers never see half of one. What a
subscription is done with is found in the file table, before any message is read.

Acknowledged messages are ranges of rows of a file. To look rows up, and to count them however ranges
overlap, ranges are cut into masks: one number says which of ``CHUNK`` neighbouring rows are hidden.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from topicflow.options import Subscription, to_millis
from topicflow.schema import (
    ACK_SCHEMA,
    DEADLINE_SCHEMA,
    FILE_ACK_SCHEMA,
    FILE_KEY,
    KEY,
    LEASE_SCHEMA,
    RETIRED_SCHEMA,
    ROWS,
    SLICE_SCHEMA,
)
from topicflow.sources.topic import read_files, read_topic, read_topic_files
from topicflow.storage import exists, find, list_dirs, make_dirs

#: Rows that a mask covers: the bits of a number.
CHUNK = 64
#: Rows of a file whose ranges are merged in one place; a range never crosses such a border.
BLOCK = 1 << 20
#: Files that the driver names one by one at most; a scan of more is a join with the file table.
FILES_AT_ONCE = 10_000


def bind(spark: SparkSession, sub: Subscription) -> None:
    """Tie the state to its topic, or refuse the state of another topic."""
    names = list_dirs(spark, sub.bound)
    ours = f"topic={sub.topic.name}"
    if not names:
        make_dirs(spark, f"{sub.bound}/{ours}")
    elif names != [ours]:
        held = ", ".join(n.removeprefix("topic=") for n in names)
        raise ValueError(f"State {sub.state_path!r} belongs to topic {held}, not {sub.topic.name}")


def check_bound(spark: SparkSession, sub: Subscription) -> None:
    """Refuse the state of another topic; state that is not there yet is tied by its first write."""
    if exists(spark, sub.bound):
        bind(spark, sub)


def superseded_acks(spark: SparkSession, sub: Subscription) -> set[str]:
    """Directories of acks that a merged one covers (``acks/..`` or ``file_acks/..``)."""
    kinds = ("acks", "file_acks")
    return {
        f"{kind}/{name}" for kind in kinds for name in list_dirs(spark, f"{sub.superseded}/{kind}")
    }


def _ack_dirs(spark: SparkSession, sub: Subscription, kind: str) -> list[str]:
    names = list_dirs(spark, f"{sub.state_path}/{kind}")
    covered = superseded_acks(spark, sub) if names else set()
    return [n for n in names if f"{kind}/{n}" not in covered]


def _ack_table(spark: SparkSession, sub: Subscription, kind: str, schema) -> DataFrame | None:
    path, names = f"{sub.state_path}/{kind}", _ack_dirs(spark, sub, kind)
    if not names:
        return None
    paths = [f"{path}/{n}" for n in names]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def read_acks(spark: SparkSession, sub: Subscription) -> DataFrame | None:
    """Ranges of messages that were acknowledged other than by whole files, or None before the first.
    Filters on ``publish_id`` prune directories."""
    return _ack_table(spark, sub, "acks", ACK_SCHEMA)


def read_file_acks(spark: SparkSession, sub: Subscription) -> DataFrame | None:
    """Files acknowledged as a whole, or None before the first."""
    return _ack_table(spark, sub, "file_acks", FILE_ACK_SCHEMA)


def _named(path: str, part: str) -> str:
    """The value of a partition column in a path."""
    return next(p for p in path.split("/") if p.startswith(f"{part}=")).removeprefix(f"{part}=")


def _leases(spark: SparkSession, sub: Subscription, paths: list[str]) -> DataFrame:
    return spark.read.schema(LEASE_SCHEMA).option("basePath", sub.leases).parquet(*paths)


def read_leases(spark: SparkSession, sub: Subscription, now: int | None = None) -> DataFrame | None:
    """Every lease as it was taken, or those that run at ``now`` with their latest deadlines; None if there is none.

    Leases that ended are told by the names of their directories and neither listed nor read,
    but for pulls of which a deadline was changed.
    """
    paths = find(spark, f"{sub.leases}/claim=*/lease_until=*/pull_id=*")
    if now is None:
        return _leases(spark, sub, paths) if paths else None
    changed = {n.removeprefix("pull_id=") for n in list_dirs(spark, sub.deadlines)}
    running = [p for p in paths if int(_named(p, "lease_until")) > now and _named(p, "pull_id") not in changed]
    tables = [_leases(spark, sub, running)] if running else []
    if kept := [p for p in paths if _named(p, "pull_id") in changed]:
        deadlines = spark.read.schema(DEADLINE_SCHEMA).parquet(sub.deadlines)
        latest = deadlines.groupBy("pull_id", *KEY).agg(F.max_by("lease_until", "sequence").alias("_latest"))
        taken = _leases(spark, sub, kept).join(latest, ["pull_id", *KEY], "left")
        taken = taken.withColumn("lease_until", F.coalesce("_latest", "lease_until")).where(F.col("lease_until") > now)
        tables.append(taken.select(*LEASE_SCHEMA.names))
    return reduce(DataFrame.unionByName, tables) if tables else None


def read_retired(spark: SparkSession, sub: Subscription) -> DataFrame | None:
    """Publishes with nothing left to deliver (see ``compact_acks``), or None."""
    if not exists(spark, sub.retired):
        return None
    return spark.read.schema(RETIRED_SCHEMA).parquet(sub.retired)


def live_files(spark: SparkSession, sub: Subscription) -> DataFrame:
    """The file table without retired publishes and without files acknowledged as a whole."""
    check_bound(spark, sub)
    files = read_files(spark, sub.topic)
    if (retired := read_retired(spark, sub)) is not None:
        files = files.join(retired, "publish_id", "left_anti")
    if (acked := read_file_acks(spark, sub)) is not None:
        files = files.join(acked.select(*FILE_KEY), FILE_KEY, "left_anti")
    return files


def ranges_of(keys: DataFrame) -> DataFrame:
    """Rows named one by one, repeats included, as the fewest ranges of a block of a file."""
    block = F.floor(F.col("position") / BLOCK)
    window = Window.partitionBy(*FILE_KEY, "_block").orderBy("position")
    numbered = keys.select(*KEY, block.alias("_block")).withColumn(
        "_island", F.col("position") - F.dense_rank().over(window)
    )
    return numbered.groupBy(*FILE_KEY, "_block", "_island").agg(
        F.min("position").alias("from_row"), (F.max("position") + 1).alias("to_row")
    ).select(*ROWS)


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that overlap or touch as one each; cut at the borders of blocks."""
    blocks = F.sequence(F.floor(F.col("from_row") / BLOCK), F.floor((F.col("to_row") - 1) / BLOCK))
    cut = ranges.where("from_row < to_row").select(*ROWS, F.explode(blocks).alias("_block"))
    cut = cut.select(
        *FILE_KEY,
        "_block",
        F.greatest("from_row", F.col("_block") * BLOCK).alias("from_row"),
        F.least("to_row", (F.col("_block") + 1) * BLOCK).alias("to_row"),
    )
    window = Window.partitionBy(*FILE_KEY, "_block").orderBy("from_row", "to_row")
    reach = F.max("to_row").over(window.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("from_row") > F.col("_reach"), F.lit(True)).cast("int")
    island = F.sum("_fresh").over(window.rowsBetween(Window.unboundedPreceding, 0))
    numbered = cut.withColumn("_reach", reach).withColumn("_fresh", fresh).withColumn("_island", island)
    return numbered.groupBy(*FILE_KEY, "_block", "_island").agg(
        F.min("from_row").alias("from_row"), F.max("to_row").alias("to_row")
    ).select(*ROWS)


def _masks(ranges: DataFrame) -> DataFrame:
    """``chunk, mask`` a file: which rows of each chunk lie in a range, however ranges overlap."""
    cut = ranges.where("from_row < to_row").selectExpr(
        *ROWS, f"explode(sequence(from_row div {CHUNK}, (to_row - 1) div {CHUNK})) as chunk"
    )
    low, high = f"greatest(from_row - chunk * {CHUNK}, 0L)", f"least(to_row - chunk * {CHUNK}, {CHUNK}L)"
    cut = cut.selectExpr(*FILE_KEY, "chunk", f"cast({low} as int) as low", f"cast({high} as int) as high")
    bits = f"if(high - low = {CHUNK}, -1L, shiftleft(shiftleft(1L, high - low) - 1L, low))"
    return cut.groupBy(*FILE_KEY, "chunk").agg(F.expr(f"bit_or({bits}) as mask"))


def path_number(path: str, part: str) -> int:
    """The number that a directory of a path is named by."""
    return int(_named(path, part))


def slice_plans(spark: SparkSession, sub: Subscription, query_id: str = "*") -> list[str]:
    """Where streams keep how they cut their latest batch into slices."""
    return find(spark, f"{sub.slices}/{query_id}/batch=*/first=*/count=*/width=*")


def slices_done(spark: SparkSession, plan: str) -> int:
    """How many slices of a batch are acknowledged: always the first ones."""
    return max((int(n) for n in list_dirs(spark, f"{plan}/_done")), default=0)


def _slice_ranges(spark: SparkSession, sub: Subscription) -> list[DataFrame]:
    """The rows that streams acknowledged by slices, one small table a stream."""
    found = []
    for plan in slice_plans(spark, sub):
        if rows := slices_done(spark, plan) * path_number(plan, "width"):
            table = spark.read.schema(SLICE_SCHEMA).parquet(plan).where(f"base < {rows}")
            found.append(table.selectExpr(*FILE_KEY, "0L as from_row", f"least(messages, {rows}L - base) as to_row"))
    return found


@dataclass(frozen=True)
class Hidden:
    """What is acknowledged by ranges or leased: ranges of rows, None if there are none. They do not
    overlap if they were written together."""

    ranges: DataFrame | None
    disjoint: bool

    @classmethod
    def of(cls, spark: SparkSession, sub: Subscription, now: int | None) -> Hidden:
        """The state of a subscription; leases count at ``now`` (None: never)."""
        acks, leases = read_acks(spark, sub), read_leases(spark, sub, now) if now is not None else None
        ranges = _slice_ranges(spark, sub)
        if leases is not None:
            ranges.append(leases.selectExpr(*FILE_KEY, "position as from_row", "position + 1 as to_row"))
        together = not ranges and acks is not None and len(_ack_dirs(spark, sub, "acks")) == 1
        if acks is not None:
            ranges.append(acks.select(*ROWS))
        return cls(reduce(DataFrame.unionByName, ranges) if ranges else None, together)

    def masks(self, publish_ids: list[str] | None = None) -> DataFrame | None:
        """The ranges as masks, of some publishes only if they are named; others are not opened."""
        if self.ranges is None:
            return None
        named = self.ranges if publish_ids is None else self.ranges.where(F.col("publish_id").isin(publish_ids))
        return _masks(named)

    def counts(self) -> DataFrame | None:
        """How many messages of each file are hidden: the lengths of ranges that do not overlap, else
        the bits of masks."""
        if self.ranges is None:
            return None
        rows, n = (self.ranges, "to_row - from_row") if self.disjoint else (_masks(self.ranges), "bit_count(mask)")
        return rows.groupBy(*FILE_KEY).agg(F.expr(f"sum({n}) as hidden"))


def without(messages: DataFrame, masks: DataFrame | None) -> DataFrame:
    """Messages (with positions) that no mask covers."""
    if masks is None:
        return messages
    joined = messages.selectExpr("*", f"position div {CHUNK} as chunk").join(masks, [*FILE_KEY, "chunk"], "left")
    bit = f"shiftright(mask, cast(position % {CHUNK} as int)) & 1L"
    return joined.where(f"mask is null or ({bit}) = 0L").select(*messages.columns)


def waiting_files(
    spark: SparkSession, sub: Subscription, now: int | None, hidden: Hidden | None = None
) -> DataFrame:
    """Live files in which messages wait, with their number: ``waiting`` beside ``messages``.

    Hidden messages are counted a file; no message is read.
    """
    files = live_files(spark, sub)
    counts = (hidden or Hidden.of(spark, sub, now)).counts()
    if counts is None:
        return files.selectExpr("*", "messages as waiting").where("waiting > 0")
    counted = files.join(counts, FILE_KEY, "left")
    return counted.selectExpr(*files.columns, "messages - coalesce(hidden, 0L) as waiting").where("waiting > 0")


def at_most(files: DataFrame, n: int | None = None) -> list[Row] | None:
    """The rows of a file table, or None if they are more than the driver should hold."""
    n = FILES_AT_ONCE if n is None else n
    rows = files.limit(n + 1).collect()
    return rows if len(rows) <= n else None


@dataclass(frozen=True)
class Files:
    """Some files of a topic: named by the driver, or if they are many a table."""

    table: DataFrame | None
    rows: list[Row] | None

    @classmethod
    def of(cls, table: DataFrame) -> Files:
        table = table.select(*FILE_KEY)
        return cls(table, at_most(table))

    @property
    def publish_ids(self) -> list[str] | None:
        """The publishes they belong to, where the driver has their names."""
        return None if self.rows is None else sorted({r.publish_id for r in self.rows})

    def messages(self, spark: SparkSession, sub: Subscription) -> DataFrame:
        """Their messages, with positions. Named files are the only ones to be listed and opened."""
        if self.rows is None:
            return read_topic(spark, sub.topic, positions=True).join(self.table, FILE_KEY, "left_semi")
        paths = sorted(f"{sub.topic.publish_path(r.publish_id)}/{r.file_name}" for r in self.rows)
        return read_topic_files(spark, sub.topic, paths, positions=True)


def waiting_messages(
    spark: SparkSession, sub: Subscription, files: Files, hidden: Hidden, *, positions: bool = True
) -> DataFrame:
    """The messages that wait in some files."""
    masks = None if files.rows == [] else hidden.masks(files.publish_ids)
    messages = without(files.messages(spark, sub), masks)
    return messages if positions else messages.drop("file_name", "position")


def eligible(spark: SparkSession, sub: Subscription, as_of: datetime | int | None = None) -> DataFrame:
    """Messages that may be delivered at ``as_of``: not acknowledged, no lease running.

    Select only the columns needed before an action, and the payload is not read.
    """
    now = to_millis(as_of)
    if not exists(spark, sub.topic.path):
        return read_topic(spark, sub.topic)
    hidden = Hidden.of(spark, sub, now)
    files = Files.of(waiting_files(spark, sub, now, hidden))
    return waiting_messages(spark, sub, files, hidden, positions=False)


def has_backlog(spark: SparkSession, sub: Subscription, as_of: datetime | int | None = None) -> bool:
    """Is any message waiting? Reads state only, no message."""
    return not waiting_files(spark, sub, to_millis(as_of)).select("publish_id").isEmpty()


def _begun(files: DataFrame) -> tuple[int, int | None, Files]:
    """Messages that wait, the publish time of the first untouched file (or None), and the files of which
    a part is done and that begin before it."""
    rows = at_most(files)
    if rows is not None:
        first = min((r.first_micros for r in rows if r.waiting == r.messages), default=None)
        parts = [r for r in rows if r.waiting < r.messages and (first is None or r.first_micros < first)]
        return sum(r.waiting for r in rows), first, Files(None, parts)
    untouched = F.col("waiting") == F.col("messages")
    totals = files.agg(
        F.sum("waiting").alias("messages"), F.min(F.when(untouched, F.col("first_micros"))).alias("first")
    ).first()
    parts = files.where(~untouched)
    if totals["first"] is not None:
        parts = parts.where(F.col("first_micros") < totals["first"])
    return totals["messages"], totals["first"], Files.of(parts)


def backlog(spark: SparkSession, sub: Subscription, as_of: datetime | int | None = None) -> DataFrame:
    """One row: how many messages wait, and the publish time of the oldest (epoch ms).

    Counts come from the file table and the state. Messages are read only in files of which a
    part is done and that begin before every untouched file.
    """
    now = to_millis(as_of)
    hidden = Hidden.of(spark, sub, now)
    waiting, first, begun = _begun(waiting_files(spark, sub, now, hidden))
    parts = waiting_messages(spark, sub, begun, hidden)
    oldest = f"least(min(unix_micros(publish_time)), cast({'null' if first is None else first} as bigint))"
    return parts.agg(F.expr(oldest).alias("oldest")).select(
        F.lit(sub.name).alias("subscription"),
        F.lit(waiting).cast("long").alias("messages"),
        F.expr("cast(floor(oldest / 1000) as bigint) as oldest_publish_timestamp"),
    )
