"""Scans of a topic: batch, chosen files, and the native file stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.options import FILE_TABLE, Topic
from topicflow.schema import FILE_SCHEMA, TOPIC_SCHEMA
from topicflow.sources.files import NO_AGE
from topicflow.storage import exists, find


def read_topic(spark: SparkSession, topic: Topic, *, positions: bool = False) -> DataFrame:
    """Every stored message. Filters on ``publish_id`` prune directories; filters on
    ``publish_time`` and ``message_id`` reach the Parquet reader. ``positions`` adds where
    each message stands: ``file_name`` and ``position``."""
    paths = [topic.path] if exists(spark, topic.path) else []
    return _read(spark, topic, paths, positions)


def read_topic_files(
    spark: SparkSession, topic: Topic, files: Sequence[str], *, positions: bool = False
) -> DataFrame:
    """The messages in some files of the topic; only these are listed and opened."""
    return _read(spark, topic, files, positions)


def _read(spark: SparkSession, topic: Topic, paths: Sequence[str], positions: bool) -> DataFrame:
    file_name, position = F.lit(None).cast("string"), F.lit(None).cast("long")
    messages = spark.createDataFrame([], TOPIC_SCHEMA)
    if paths:
        file_name, position = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        messages = (
            spark.read.schema(TOPIC_SCHEMA).option("basePath", topic.path).parquet(*paths)
        )
    if not positions:
        return messages
    return messages.select(*TOPIC_SCHEMA.names, file_name.alias("file_name"), position.alias("position"))


def read_files(spark: SparkSession, topic: Topic) -> DataFrame:
    """The file table of the topic: one small row for each stored file."""
    paths = find(spark, topic.file_tables)
    if not paths:
        return spark.createDataFrame([], FILE_SCHEMA)
    return spark.read.schema(FILE_SCHEMA).parquet(*paths)


def read_publish_files(spark: SparkSession, topic: Topic, publish_ids: Sequence[str]) -> DataFrame:
    """The rows of the file table of some publishes; only theirs are listed."""
    paths = [f"{topic.publish_path(p)}/{FILE_TABLE}" for p in publish_ids]
    return spark.read.schema(FILE_SCHEMA).parquet(*paths)


def file_rows(staged: DataFrame, publish_id: str) -> DataFrame:
    """Rows of the file table for files of messages that are not visible yet."""
    micros = F.unix_micros("publish_time")
    return staged.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.min(micros).alias("first_micros"),
        F.max(micros).alias("last_micros"),
    ).select(F.lit(publish_id).alias("publish_id"), "file_name", "messages", "first_micros", "last_micros")


def stream_topic(
    spark: SparkSession,
    topic: Topic,
    *,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """The topic as a file stream: new publishes arrive as new directories.

    A trigger takes at most ``max_files`` files, or files of about ``max_bytes`` in all.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("Give max_files or max_bytes, not both")
    reader = spark.readStream.schema(TOPIC_SCHEMA).option("maxFileAge", NO_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(topic.path)
