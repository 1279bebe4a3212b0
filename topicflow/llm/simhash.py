"""SimHash near-duplicates: 64-bit fingerprints joined by multi-index hashing.

A fingerprint is cut into two segments of 32 bits. Two fingerprints that differ in at most two
bits differ in at most one bit of the high segment, or in none of the low segment. So a table
holds every fingerprint under each of its segments; a fingerprint asks for the Hamming ball of
radius 1 around its high segment (33 keys) and of radius 0 around its low segment (1 key), and
what the table returns is compared in full.

Copies of a fingerprint are one entry. A key that holds many different fingerprints would still
pair all of them, so the fingerprints of a key with more than ``BUCKET`` entries, and those that
ask for it, are indexed again by finer keys: all points at most one bit away, whole. Two such
fingerprints share a point exactly if they differ in two bits or fewer, and no point has
more than 65 different fingerprints, so nothing is lost and no pair list grows with a group.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import as_bytes, map_text, stored
from topicflow.llm.graph import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
#: Entries of a key above which its fingerprints are indexed by finer keys.
BUCKET = 64


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a UTF-8 text, as an unsigned number."""
    tokens = text.lower().split()  # of bytes: A-Z, and the six ASCII white-space characters
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    digest, shingles = xxhash.xxh64_digest, zip(*(tokens[i:] for i in range(words)))
    n, counts = len(tokens) - words + 1, np.zeros(64, dtype=np.int64)
    while part := [digest(b" ".join(s), SEED) for s in islice(shingles, 65536)]:
        octets = np.frombuffer(b"".join(part), dtype=np.uint8)
        counts += np.unpackbits(octets).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of every document; null text is empty."""

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [fingerprint(t, words) for t in as_bytes(batch, "text")]
            signed = np.array(found, dtype=np.uint64).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"]
            )

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs.select("doc_id", "text"), "text", f"doc_id {kind}, fp bigint", start)


def _high(fp: str = "fp") -> Column:
    return F.shiftrightunsigned(fp, 32)


def _low(fp: str = "fp") -> Column:
    return F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF))


def _entry(segment: int, value: Column) -> Column:
    return F.struct(F.lit(segment).alias("segment"), value.alias("value"))


def _flips(value: Column, bits: range) -> Column:
    """The value itself and each value one bit away."""
    masks = F.array(F.lit(0).cast("bigint"), *[F.lit(_signed(1 << b)) for b in bits])
    return F.transform(masks, lambda m: value.bitwiseXOR(m))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``src, dst``: links whose components are those of all pairs within ``MAX_BITS`` bits.

    ``fps`` has different fingerprints in ``fp``. Returns verified pairs, and for the finer keys
    a star of verified pairs a key.
    """
    table = fps.select("fp", F.inline(F.array(_entry(0, _high()), _entry(1, _low()))))
    sizes = table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n"))
    # written, so that joins with it have a shuffle on both sides and a common key can be split
    large = stored(sizes.where(F.col("n") > bucket).select("segment", "value"))
    balls = F.concat(
        F.transform(_flips(_high(), range(32)), lambda v: _entry(0, v)), F.array(_entry(1, _low()))
    )
    probes = fps.select("fp", F.inline(balls))

    small = table.join(large, ["segment", "value"], "left_anti")
    asked = probes.withColumnRenamed("fp", "other")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_BITS
    # Spark sizes a table by its file, not by what an explode makes of it: left to it, 34 rows a fingerprint are broadcast
    pairs = small.join(asked.hint("merge"), ["segment", "value"]).where((F.col("fp") != F.col("other")) & near)
    pairs = pairs.select(F.col("fp").alias("src"), F.col("other").alias("dst"))

    dense = probes.join(large, ["segment", "value"], "left_semi").select("fp").distinct()
    points = dense.select("fp", F.explode(_flips(F.col("fp"), range(64))).alias("point"))
    hubs = points.groupBy("point").agg(F.min("fp").alias("hub"), F.max("fp").alias("last"))
    hubs = hubs.where("hub <> last").select("point", "hub")
    stars = points.join(hubs.hint("merge"), "point").where(
        (F.col("fp") != F.col("hub"))
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= MAX_BITS)
    )
    return pairs.union(stars.select("hub", "fp")).distinct()


def simhash_components(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs`` (``doc_id, text``; others ignored).

    Documents whose fingerprints differ in at most two bits are linked; ``component_id`` is the
    smallest ``doc_id`` that links reach. Null and empty texts have fingerprint zero and are linked
    like any other. Rows of one ``doc_id`` stay separate rows. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs))
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = stored(links(classes.select("fp")))
    reached = components(found).withColumnRenamed("node", "fp")
    labelled = classes.join(reached, "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    # classes are many and small: the smallest document of a component by aggregation, then back
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = labelled.join(smallest, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(fp: str = "fp") -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest ``doc_id`` of their component; columns unchanged.

    Rows that repeat a kept ``doc_id`` stay as they came only once. Rows of a null ``doc_id`` can't be
    told to be a copy of any document, and all stay.
    """
    found = simhash_components(docs)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    first = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    return first.union(docs.where(F.col("doc_id").isNull()))
