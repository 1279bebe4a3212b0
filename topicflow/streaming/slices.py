"""Micro-batches of so many messages: a cursor inside files.

A trigger brings files. Their rows, file behind file, are cut every so many rows; the order of the files and
the width of a slice are stored before the first slice is handled, so a replay cuts alike. A slice is
acknowledged by the number of slices done beside that, from which pulls tell the rows. Where
slices are small parts of files, the files are read once for many slices and dealt to a directory a
slice, so work follows the messages and not slices times files.

Slices may be given to the handler several at a time. Which ones is stored before they are handled, so a
replay gives the same ones together, whatever number it is asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.operators.state import Files, path_number, slice_plans
from topicflow.options import Subscription
from topicflow.schema import FILE_KEY, SLICE_SCHEMA
from topicflow.sources.topic import read_publish_files
from topicflow.storage import delete, list_dirs, make_dirs, write_once

#: Slices, or groups of slices that are handled together, that one pass over their files is dealt to.
AT_ONCE = 200


@dataclass(frozen=True)
class Part:
    """Rows ``from_row`` to before ``to_row`` of a file; ``base`` rows of the batch stand before the file."""

    publish_id: str
    file_name: str
    base: int
    from_row: int
    to_row: int


@dataclass(frozen=True)
class Plan:
    """The slices of a micro-batch, stored at ``path``; ``first`` is the offset of the first one."""

    path: str
    files: list[Part]
    first: int
    width: int

    @property
    def total(self) -> int:
        return sum(f.to_row for f in self.files)

    @property
    def count(self) -> int:
        return -(-self.total // self.width)

    def parts(self, begin: int, end: int) -> list[Part]:
        """The rows of slices ``begin`` to before ``end``."""
        low, high = begin * self.width, end * self.width
        return [
            Part(f.publish_id, f.file_name, f.base, max(0, low - f.base), min(f.to_row, high - f.base))
            for f in self.files
            if f.base < high and f.base + f.to_row > low
        ]


def plan(
    spark: SparkSession, sub: Subscription, query_id: str, batch_id: int, files: list[tuple[str, str]], width: int
) -> Plan:
    """The stored plan of a micro-batch, else one of ``files``, stored.

    Offsets go on from the plan before, of which only the latest is kept.
    """
    base = f"{sub.slices}/{query_id}"
    stored = slice_plans(spark, sub, query_id)
    own = [p for p in stored if path_number(p, "batch") == batch_id]
    if not own:
        first = max((path_number(p, "first") + path_number(p, "count") for p in stored), default=1)
        asked, at, rows = set(files), 0, []
        held = read_publish_files(spark, sub.topic, sorted({p for p, _ in files})).collect()
        for r in sorted(held, key=lambda r: (r.first_micros or 0, r.publish_id, r.file_name)):
            if (r.publish_id, r.file_name) in asked:
                rows.append((r.publish_id, r.file_name, at, r.messages))
                at += r.messages
        inside = f"first={first}/count={-(-at // width)}/width={width}"
        write_once(_table(spark, rows), f"{base}/batch={batch_id}", sub.staging, inside=inside)
        for path in stored:
            delete(spark, f"{base}/batch={path_number(path, 'batch')}")
        own = [f"{base}/batch={batch_id}/{inside}"]
    rows = spark.read.schema(SLICE_SCHEMA).parquet(own[0]).orderBy("base", "messages").collect()
    parts = [Part(r.publish_id, r.file_name, r.base, 0, r.messages) for r in rows]
    return Plan(own[0], parts, path_number(own[0], "first"), path_number(own[0], "width"))


def _table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A few rows that the driver holds, as many as a trigger admits files."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return spark.createDataFrame(pa.table(dict(zip(SLICE_SCHEMA.names, arrays)))).coalesce(1)


def begin_group(spark: SparkSession, made: Plan, begin: int, end: int) -> None:
    """Store that slices ``begin`` to before ``end`` are handled together."""
    make_dirs(spark, f"{made.path}/_given/{begin}-{end}")


def _begun(spark: SparkSession, made: Plan, done: int) -> int:
    """The end of the group that was begun with slice ``done`` and not acknowledged; ``done`` if there is none."""
    given = (map(int, name.split("-")) for name in list_dirs(spark, f"{made.path}/_given"))
    return max((end for begin, end in given if begin == done), default=done)


def finish(spark: SparkSession, made: Plan, end: int) -> None:
    """Acknowledge all slices before ``end``."""
    make_dirs(spark, f"{made.path}/_done/{end}")


def _scan(spark: SparkSession, sub: Subscription, parts: list[Part]) -> DataFrame:
    """The messages of some parts, with positions; all but the first and the last are whole files."""
    messages = Files(None, parts).messages(spark, sub)
    for p in {parts[0], parts[-1]}:
        own = (F.col("publish_id") == p.publish_id) & (F.col("file_name") == p.file_name)
        messages = messages.where(~own | F.col("position").between(p.from_row, p.to_row - 1))
    return messages


def _numbered(spark: SparkSession, sub: Subscription, made: Plan, begin: int, end: int) -> DataFrame:
    """The messages of slices ``begin`` to before ``end``, with positions and the slice of each (``_slice``)."""
    parts = made.parts(begin, end)
    messages = _scan(spark, sub, parts)
    if end - begin == 1:
        return messages.withColumn("_slice", F.lit(begin).cast("long"))
    # one small row for each file that a trigger admits
    bases = F.broadcast(_table(spark, [(p.publish_id, p.file_name, p.base, 0) for p in parts]).drop("messages"))
    number = F.floor((F.col("base") + F.col("position")) / made.width)
    return messages.join(bases, FILE_KEY).select(*messages.columns, number.alias("_slice"))


def read(
    spark: SparkSession, sub: Subscription, made: Plan, done: int, at_once: int = 1
) -> Iterator[tuple[int, int, DataFrame]]:
    """Begin, end and messages (with positions and ``_slice``) of every group of ``at_once`` slices but the
    first ``done`` slices; a group that was begun before comes as it was.

    Files that are cut into more than two groups on average are dealt to groups in passes of ``AT_ONCE``.
    """
    if done >= made.count:
        return
    begun = _begun(spark, made, done)
    edges = sorted({done, *range(begun, made.count, at_once), made.count})
    groups = list(zip(edges, edges[1:]))
    if made.count <= 2 * len(made.files) * at_once:
        for begin, end in groups:
            yield begin, end, _numbered(spark, sub, made, begin, end)
        return
    for i in range(0, len(groups), AT_ONCE):
        some = groups[i : i + AT_ONCE]
        messages = _numbered(spark, sub, made, some[0][0], some[-1][1])
        # the group that was begun before is -1, or else there is none
        group = F.greatest(F.lit(-1), F.floor((F.col("_slice") - begun) / at_once))
        path = f"{sub.staging}/{uuid.uuid4().hex}"
        messages.withColumn("_group", group).write.partitionBy("_group").parquet(path)
        try:
            for begin, end in some:
                number = (begin - begun) // at_once if begin >= begun else -1
                yield begin, end, spark.read.schema(messages.schema).parquet(f"{path}/_group={number}")
        finally:
            delete(spark, path)
