"""Upkeep of delivery state, so that a pull costs what is waiting and not what ever was.

It may run while pulls and streams use the subscription: directories that are merged are first
passed over by name and removed by a later run, when no query can still have listed them.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.operators.delivery import ack_files
from topicflow.operators.state import (
    Hidden,
    live_files,
    merged_ranges,
    read_acks,
    read_file_acks,
    read_retired,
    superseded_acks,
)
from topicflow.options import Subscription, Topic, to_millis
from topicflow.schema import FILE_KEY, ROWS
from topicflow.sources.topic import read_files
from topicflow.storage import delete, find, list_dirs, make_dirs, modified_at, write_once


def compact_acks(
    spark: SparkSession, sub: Subscription, *, keep_seconds: int = 24 * 3600
) -> DataFrame:
    """Sum up acks: ranges that overlap or touch by one each, complete files by one row, complete
    publishes by their name.

    A complete file or publish is left out of the file table of the subscription, and the acks
    of ranges it held are dropped. Returns the newly retired publishes. Directories
    merged more than ``keep_seconds`` ago are removed.
    """
    run = f"compact-{uuid.uuid4().hex}"
    _remove_superseded(spark, sub, keep_seconds)
    files = live_files(spark, sub)
    if (acked := Hidden.of(spark, sub, None).counts()) is not None:
        complete = files.join(acked, FILE_KEY).where(F.col("hidden") >= F.col("messages"))
        ack_files(complete, sub, ack_id=run)

    published = read_files(spark, sub.topic).select("publish_id").distinct()
    if (retired := read_retired(spark, sub)) is not None:
        published = published.join(retired, "publish_id", "left_anti")
    unfinished = live_files(spark, sub).select("publish_id")
    path = f"{sub.retired}/run={run}"
    write_once(published.join(unfinished, "publish_id", "left_anti"), path, sub.staging)

    done = read_retired(spark, sub)
    if (table := read_file_acks(spark, sub)) is not None:
        kept = table.join(done, "publish_id", "left_anti")
        rows = kept.groupBy(*FILE_KEY).agg(F.min("acked_at").alias("acked_at"))
        _merge(sub, "file_acks", table, rows, FILE_KEY, run)
    complete = read_file_acks(spark, sub)
    if (table := read_acks(spark, sub)) is not None:
        kept = table.join(done, "publish_id", "left_anti")
        kept = kept.join(complete.select(*FILE_KEY), FILE_KEY, "left_anti") if complete is not None else kept
        rows = merged_ranges(kept).withColumn("acked_at", F.lit(to_millis(None)).cast("long"))
        _merge(sub, "acks", table, rows, ROWS, run)
    return spark.read.schema(done.schema).parquet(path)


def _merge(sub: Subscription, kind: str, table: DataFrame, rows: DataFrame, key: list[str], run: str) -> None:
    """``rows`` as one directory in place of those that ``table`` was listed from.

    An ack that arrives in between is in none of them and stays. Until they are passed over
    an ack is there twice, which changes nothing.
    """
    spark, path = table.sparkSession, f"{sub.state_path}/{kind}"
    merged = sorted({f.split(f"/{kind}/")[-1].split("/")[0] for f in table.inputFiles()})
    rows = rows.select(F.lit(sub.name).alias("subscription"), *key, "acked_at")
    write_once(rows, f"{path}/ack_id={run}-merged", sub.staging, sort_by=key, partition_by=["publish_id"])
    for name in merged:
        make_dirs(spark, f"{sub.superseded}/{kind}/{name}")


def _remove_superseded(spark: SparkSession, sub: Subscription, keep_seconds: int) -> None:
    oldest = to_millis(None) - 1000 * keep_seconds
    for name in superseded_acks(spark, sub):
        mark = f"{sub.superseded}/{name}"
        if modified_at(spark, mark) <= oldest:
            delete(spark, f"{sub.state_path}/{name}")
            delete(spark, mark)


def drop_expired_leases(
    spark: SparkSession,
    sub: Subscription,
    *,
    keep_seconds: int = 7 * 24 * 3600,
    as_of: datetime | int | None = None,
) -> list[str]:
    """Remove leases whose every deadline is more than ``keep_seconds`` ago; their pulls can no longer be
    acknowledged. Returns when they ended, as the names of their directories."""
    oldest = to_millis(as_of) - 1000 * keep_seconds
    latest = max(list_dirs(spark, sub.leases), key=lambda n: int(n.removeprefix("claim=")), default=None)
    gone = []
    for path in find(spark, f"{sub.leases}/claim=*/lease_until=*/pull_id=*"):
        claim, until, pull = path.rsplit("/", 3)[1:]
        changes = find(spark, f"{sub.deadlines}/{pull}/sequence=*/lease_until=*")
        ends = [int(p.rsplit("=", 1)[1]) for p in (f"x={until.removeprefix('lease_until=')}", *changes)]
        if max(ends) < oldest:
            # the number of the latest claim stays, so that no later one gets it again
            delete(spark, f"{sub.leases}/{claim}" if claim != latest else path.rsplit("/", 1)[0])
            delete(spark, f"{sub.deadlines}/{pull}")
            gone.append(until)
    for claim in list_dirs(spark, sub.leases):
        if claim != latest and not list_dirs(spark, f"{sub.leases}/{claim}"):
            delete(spark, f"{sub.leases}/{claim}")
    return gone


def drop_stale_staging(
    spark: SparkSession, target: Topic | Subscription, *, older_than_seconds: int = 24 * 3600
) -> list[str]:
    """Remove what crashed writers left in staging. Returns the removed directories."""
    oldest = to_millis(None) - 1000 * older_than_seconds
    paths = [f"{target.staging}/{name}" for name in list_dirs(spark, target.staging)]
    stale = [path for path in paths if modified_at(spark, path) < oldest]
    for path in stale:
        delete(spark, path)
    return stale
