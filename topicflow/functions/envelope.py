"""Column expressions that turn stored messages into the seven-column envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attributes_text(attributes: Column) -> Column:
    """``{k=v, k2=v2}``; an empty or missing map is ``{}``."""
    pairs = F.transform(
        F.map_entries(attributes), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    joined = F.coalesce(F.array_join(pairs, ", "), F.lit(""))
    return F.concat(F.lit("{"), joined, F.lit("}"))


def utc_timestamp(column: Column, type_name: str) -> Column:
    """A timestamp column as an instant; one without a time zone is read as UTC.

    The local time goes through its text with an explicit zone: a cast would read it in the zone
    of the session, where an hour may be missing.
    """
    if type_name == "timestamp_ntz":
        return F.concat(column.cast("string"), F.lit("Z")).cast("timestamp")
    return column.cast("timestamp")


def epoch_millis(instant: Column) -> Column:
    """Epoch ms, rounded down."""
    return F.unix_millis(instant)


def pull_time(as_of: int | None) -> Column:
    """Epoch ms of the pull: the given value, or the clock of the query."""
    return F.unix_millis(F.current_timestamp()) if as_of is None else F.lit(as_of).cast("long")


def to_envelope(
    messages: DataFrame, subscription: str, *, offset: int | Column = -1, as_of: int | None = None
) -> DataFrame:
    """The envelope as one projection. ``offset`` is -1 where no batch is counted."""
    return messages.select(
        F.lit(subscription).alias("subscription"),
        F.lit(offset).cast("long").alias("offset"),
        F.col("data"),
        epoch_millis(F.col("publish_time")).alias("publish_timestamp"),
        pull_time(as_of).alias("event_timestamp"),
        attributes_text(F.col("attributes")).alias("attributes"),
        F.col("message_id"),
    )
