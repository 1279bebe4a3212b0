"""CSV directories as stream source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from topicflow.options import TRIGGER_OPTIONS, check_output_mode, checked
from topicflow.streaming.control import with_trigger

#: Files of any age are read. A file stream else drops files a week older than its newest one.
NO_AGE = "36500d"


def stream_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, *, max_files: int | None = None
) -> DataFrame:
    """New CSV files in a directory, without header, under the given schema."""
    reader = spark.readStream.option("header", "false").option("maxFileAge", NO_AGE).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def write_stream_csv(
    df: DataFrame,
    path: str,
    *,
    output_mode: str = "append",
    **options,
) -> StreamingQuery:
    """Append a streaming DataFrame to a CSV directory, without header.

    CSV has no binary type: such columns are written as the text they hold. Options:
    ``checkpoint``, ``available_now`` or ``interval``.
    """
    check_output_mode(output_mode)
    columns = [
        F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.BinaryType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    writer = df.select(*columns).writeStream.outputMode("append").format("csv")
    known = checked(options, *TRIGGER_OPTIONS)
    return with_trigger(writer.option("header", "false"), known).start(path)
