"""What the operators share: slices of Arrow batches, tables in the shared folder, one-column maps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from topicflow.storage import delete, shared_scratch

#: Bytes of text that a Python worker holds as objects at a time; one longer text is a slice alone.
SLICE_BYTES = 2_000_000


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows written to the shared folder of the session and read back.

    Cuts the lineage: a lost executor costs a read, not a recomputation, and a result that is
    used twice is computed once.
    """
    path = f"{folder or shared_scratch(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table of ``stored`` that nothing reads any more: what came of it is stored, too."""
    for file in table.inputFiles()[:1]:
        delete(table.sparkSession, unquote(file.rsplit("/", 1)[0]))


def parallelism(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        group = np.cumsum(sizes, dtype=np.int64) // size
        edges = np.flatnonzero(np.diff(group)) + 1
        for begin, end in zip([0, *edges], [*edges, batch.num_rows]):
            yield batch.slice(begin, end - begin)


def parts_between_spaces(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The number of the part at each place, the distinct parts, and the place where each text begins, with
    the end of the last one. An empty text has one empty part."""
    cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    parts = cut.flatten().dictionary_encode()
    edges = cut.offsets.to_numpy().astype(np.int64)
    return parts.indices.to_numpy().astype(np.int64), parts.dictionary.to_numpy(zero_copy_only=False).tolist(), edges


_GAP = np.zeros(256, bool)
_GAP[[*range(9, 14), 32]] = True


def text_bytes(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind one another, and the place where each begins, with the end of the last one; null is empty."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[edges[0] : edges[-1]], edges - edges[0]


def word_places(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word (without ASCII white space) of the texts of ``text_bytes``, and the first word of
    each text, with the number of all words."""
    gap, edge = np.ones(len(data) + 2, bool), np.zeros(len(data) + 1, bool)
    gap[1:-1], edge[edges] = _GAP[data], True
    inside = ~gap[1:-1]
    begins = np.flatnonzero(inside & (gap[:-2] | edge[:-1]))
    return begins, np.flatnonzero(inside & (gap[2:] | edge[1:])) + 1, np.searchsorted(begins, edges)


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def map_text(
    df: DataFrame,
    column: str,
    schema: str,
    start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    size: int = SLICE_BYTES,
) -> DataFrame:
    """``mapInArrow`` over slices of ``size`` bytes. ``start`` runs once a task and returns the function of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for part in slices(batches, column, size):
            yield each(part)

    return df.mapInArrow(run, schema)
