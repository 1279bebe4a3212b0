"""Directories on the shared file system: listing, and all-or-nothing creation.

Everything goes through the Hadoop file system the session is configured with, so a root
may be any URI Spark can write. Creating a directory relies on an atomic directory rename
(HDFS, a POSIX file system, or an object store with a hierarchical namespace).
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


_path_class: tuple = (None, None)


def _path(spark: SparkSession, path: str):
    global _path_class
    jvm = spark.sparkContext._jvm
    if _path_class[0] is not jvm:  # looking a class up costs several calls
        _path_class = jvm, jvm.org.apache.hadoop.fs.Path
    return _path_class[1](path)


def _file_system(spark: SparkSession, path: str):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return _path(spark, path).getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under ``path``; none if it does not exist."""
    files, folder = _file_system(spark, path), _path(spark, path)
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory())


def find(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    found = _file_system(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(s.getPath().toString() for s in found or [])


def make_dirs(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).mkdirs(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def modified_at(spark: SparkSession, path: str) -> int:
    """Modification time in epoch ms."""
    return _file_system(spark, path).getFileStatus(_path(spark, path)).getModificationTime()


def _rename_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a directory; False if the target exists already.

    ``FileContext.rename`` without options refuses an existing target. The older
    ``FileSystem.rename`` would move the source *into* it.
    """
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _file_system(spark, target).getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename_option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    no_options = spark.sparkContext._gateway.new_array(rename_option, 0)
    make_dirs(spark, target.rsplit("/", 1)[0])
    try:
        context.rename(_path(spark, source), _path(spark, target), no_options)
    except Py4JJavaError:
        if exists(spark, target):
            return False
        raise
    return True


_writers: dict[str, tuple[int, str]] = {}
_writers_lock = threading.Lock()


@contextmanager
def _timestamps_with_statistics(spark: SparkSession) -> Iterator[None]:
    """Store timestamps as 64-bit microseconds while writing.

    The older 96-bit form is still the default; it has no statistics, so no filter on a
    publish time could skip data. Writes that overlap in one session are counted: the first
    changes the setting, the last one puts it back.
    """
    name, session = "spark.sql.parquet.outputTimestampType", spark._jsparkSession.sessionUUID()
    with _writers_lock:
        running, before = _writers.get(session, (0, spark.conf.get(name)))
        _writers[session] = (running + 1, before)
        spark.conf.set(name, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        with _writers_lock:
            running, before = _writers[session]
            if running > 1:
                _writers[session] = (running - 1, before)
            else:
                del _writers[session]
                spark.conf.set(name, before)


def write_once(
    df: DataFrame,
    target: str,
    staging: str,
    *,
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 0,
    fmt: str = "parquet",
    beside: tuple[str, Callable[[DataFrame], DataFrame]] | None = None,
    inside: str = "",
) -> bool:
    """Write ``df`` as the directory ``target``, all or nothing.

    Executors write to a fresh directory under ``staging``; one rename makes the result
    visible. Returns False, and writes nothing, if ``target`` exists: a replay of work that
    was committed before. A crashed attempt leaves only its own staging directory. ``beside``
    names a table inside the directory and makes it from what was written. ``inside`` is where in the
    directory the rows go, if not directly.
    """
    spark = df.sparkSession
    if exists(spark, target):
        return False
    staged = f"{staging}/{uuid.uuid4().hex}"
    schema = df.schema
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    with _timestamps_with_statistics(spark):
        writer = df.write.option("maxRecordsPerFile", max_records_per_file)
        writer.partitionBy(*partition_by).format(fmt).save(f"{staged}/{inside}" if inside else staged)
    if beside:
        name, rows = beside
        rows(spark.read.schema(schema).parquet(staged)).write.parquet(f"{staged}/{name}")
    created = _rename_if_absent(spark, staged, target)
    if not created:
        delete(spark, staged)
    return created


def create_once(spark: SparkSession, target: str, staging: str) -> bool:
    """Create an empty directory; False if it exists. Of several at once one succeeds."""
    staged = f"{staging}/{uuid.uuid4().hex}"
    make_dirs(spark, staged)
    created = _rename_if_absent(spark, staged, target)
    if not created:
        delete(spark, staged)
    return created


def name_table(spark: SparkSession, rows: Sequence[tuple], *columns: str) -> DataFrame:
    """A few rows of text the driver holds (names of files or messages) as a local table."""
    table = pa.table({c: pa.array([r[i] for r in rows], pa.string()) for i, c in enumerate(columns)})
    return spark.createDataFrame(table).coalesce(1)


def shared_scratch(spark: SparkSession) -> str:
    """A new directory for intermediate tables that every executor can reach.

    Uses the folder named by ``spark.checkpoint.dir``. Only a local session that names none
    falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="topicflow-")
    return f"{base.rstrip('/')}/topicflow-{uuid.uuid4().hex}"
