"""Importance resampling towards a target distribution of hashed words.

Features of a text are its runs of words; a feature's bucket is a CRC of its bytes. A bucket's gain says
how much more frequent it is in the target texts than in all documents, a document's weight is the sum
of its features' gains, and documents are drawn without replacement by weight plus a hashed Gumbel number.

Words are counted over all documents first. The most frequent ones form the head: their CRC states are
computed once and broadcast, and so are the buckets of the frequent pairs among them. Other features, the
tail, take their CRC where they are met; a run goes on from the state of the run before its last word.
Which features are in the head changes the speed only: both feed the same exact totals of buckets.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicflow.llm.common import as_bytes, discard, map_text, parallelism, slices, stored

BUCKETS = 10_000
#: Words of a feature at most.
LONGEST = 1
SEED = 2024
#: Percent of the documents of ``MIN_WORDS`` words that are drawn.
SHARE, MIN_WORDS = 10, 20
#: Words, and pairs, of the head at most, the bytes of one at most, and the times that it stands in the
#: documents at least: so the head is 8 MB at most.
HEAD, HEAD_BYTES, HEAD_COUNT = 65_536, 64, 16
#: Different features that a task counts, or words that it remembers, before it lets go of them.
REMEMBERED = 200_000

# Bytes of words are 0-9, a-z after A-Z are lower-cased, and all of other characters.
_WORD_BYTES = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b in _WORD_BYTES else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


@dataclass(frozen=True)
class Head:
    """CRC states of frequent words, and of frequent pairs of them."""

    words: dict[bytes, int]
    pairs: dict[tuple[bytes, bytes], int]


class Features:
    """Buckets of the features of texts, by the head and by direct CRC."""

    def __init__(self, head: Head, buckets: int, longest: int):
        self.head, self.buckets, self.longest = head, buckets, longest
        self.states = _States(head.words)

    def buckets_of(self, words: list[bytes]) -> np.ndarray:
        """The bucket of every feature, repeats included."""
        states: list[int] = list(map(self.states.__getitem__, words))
        parts = [states]
        for n in range(2, min(self.longest, len(words)) + 1):
            if n == 2:
                pairs = self.head.pairs
                states = [
                    found if (found := pairs.get((a, b))) is not None else crc32(b" " + b, s)
                    for s, a, b in zip(states, words, words[1:])
                ]
            else:
                states = [crc32(b" " + w, s) for s, w in zip(states, words[n - 1 :])]
            parts.append(states)
        flat = np.fromiter((s for part in parts for s in part), np.int64, sum(map(len, parts)))
        return flat % self.buckets


class _States(dict):
    """CRC of words: those of the head, and others as they come."""

    def __init__(self, head: dict[bytes, int]):
        super().__init__(head)
        self.head = head

    def __missing__(self, word: bytes) -> int:
        if len(self) >= len(self.head) + REMEMBERED:
            self.clear()
            self.update(self.head)
        state = self[word] = crc32(word)
        return state


def _counted(docs: DataFrame, features) -> DataFrame:
    """``feature, n``: features counted over all documents, in each task before the shuffle.

    ``features`` runs once a task and returns the function that lists those of a text's words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, each = Counter(), features()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(counts.values(), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["feature", "n"])

        for batch in slices(batches, "text"):
            for text in as_bytes(batch, "text"):
                counts.update(each(words_of(text)))
            if len(counts) > REMEMBERED:
                yield out()
        yield out()

    partial = docs.select("text").mapInArrow(run, "feature binary, n bigint")
    return partial.groupBy("feature").agg(F.sum("n").alias("n"))


def _most_frequent(counted: DataFrame, most: int) -> list[bytes]:
    """Those that stand ``HEAD_COUNT`` times or more, from some count on, ``most`` at most.

    The count is read from a histogram of at most some hundred steps, so no more than is used leaves the
    executors.
    """
    few = counted.where((F.col("n") >= HEAD_COUNT) & (F.octet_length("feature") <= HEAD_BYTES))
    few = stored(few.select("feature", F.floor(F.log2("n") * 8).cast("int").alias("step")))
    from_step, total = None, 0
    for row in few.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > most:
            break
        from_step = row["step"]
    found = [] if from_step is None else few.where(F.col("step") >= from_step).select("feature").collect()
    discard(few)
    return sorted(bytes(r.feature) for r in found)


def head_of(docs: DataFrame, longest: int = LONGEST, most: int = HEAD) -> Head:
    """The head of all documents. A pair can be frequent only if both its words are, so pairs are
    counted among the words of the head."""

    def every_word():
        return lambda words: words

    words = {w: crc32(w) for w in _most_frequent(_counted(docs, every_word), most)}
    if longest < 2:
        return Head(words, {})
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(words))

    def head_pairs():
        known = shared.value
        return lambda words: [a + b" " + b for a, b in zip(words, words[1:]) if a in known and b in known]

    pairs = _most_frequent(_counted(docs, head_pairs), most)
    return Head(words, {tuple(p.split(b" ")): crc32(p) for p in pairs})


def _lists(spark: SparkSession, head: Head, buckets: int, longest: int):
    """The function that starts ``Features`` in a task."""
    shared = spark.sparkContext.broadcast(head)
    return lambda: Features(shared.value, buckets, longest)


def bucket_totals(docs: DataFrame, head: Head, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all documents fall into each bucket: one array a task, summed by bucket."""
    start = _lists(docs.sparkSession, head, buckets, longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, totals = start(), np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            for text in as_bytes(batch, "text"):
                totals += np.bincount(features.buckets_of(words_of(text)), minlength=buckets)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["bucket", "n"])

    partial = docs.select("text").mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of a nat that a feature of each bucket adds to a weight, rounded down."""
    n, s, t = float(len(source)), source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighed(docs: DataFrame, head: Head, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``doc_id, _n_words, n_features, weight`` of every row of ``docs``."""
    spark = docs.sparkSession
    start_features = _lists(spark, head, len(gain), longest)
    shared = spark.sparkContext.broadcast(gain)

    def start():
        features, own = start_features(), shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, sizes, weights = [], [], []
            for text in as_bytes(batch, "text"):
                words = words_of(text)
                buckets = features.buckets_of(words)
                counts.append(len(words))
                sizes.append(len(buckets))
                weights.append(int(own[buckets].sum()))
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (counts, sizes, weights))]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "_n_words", "n_features", "weight"])

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, _n_words bigint, n_features bigint, weight bigint"
    return map_text(docs.select("doc_id", "text"), "text", schema, start)


def gumbel(seed: int) -> Column:
    """A hashed Gumbel number of the document's id, in thousandths, rounded down."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def ranked(scored: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (``doc_id, _n_words, n_features, weight, score``) with ``rank`` in place of ``_n_words``.

    Rows are dealt to ranges of the order, and their numbers follow from how many rows the ranges
    before have, so no task sorts all of them; the driver sees one number a range. Rows that repeat
    an id differ by where they are stored, so a range can end between them.
    """
    spark = scored.sparkSession
    first = stored(scored)
    order = ["_short", F.desc("score"), F.col("doc_id").asc_nulls_last(), "_file", "_row"]
    placed = first.select(
        "*",
        (F.col("_n_words") < min_words).alias("_short"),
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    dealt = placed.repartitionByRange(parallelism(spark), *order).withColumn("_range", F.spark_partition_id())
    ranges = stored(dealt)
    discard(first)
    long = F.count(F.when(~F.col("_short"), 1))
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), long.alias("long")).orderBy("_range").collect()
    drawn = share * sum(r.long for r in sizes) // 100
    before = np.cumsum([0, *(r.n for r in sizes)])[:-1]
    bases = pa.table({"_range": pa.array([r._range for r in sizes], pa.int32()), "_base": pa.array(before, pa.int64())})
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_base")
    # one small row for each range of a shuffle
    numbered = ranges.join(F.broadcast(spark.createDataFrame(bases)), "_range").withColumn("_number", number)
    rank = F.when(F.col("_number") <= drawn, F.col("_number")).cast("bigint")
    return numbered.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    head: int = HEAD,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null if it is not drawn.

    ``docs`` needs ``doc_id`` and ``text``, ``target`` only ``text``; other columns are ignored, whatever
    their names. Of the documents of ``min_words`` words or more ``share`` percent are drawn, those
    of highest score, ties to the smaller ``doc_id``. Features are runs of 1 to ``longest`` words, of whole
    texts of any length. Null and empty texts have no features, weight 0, and are drawn only if
    ``min_words`` is 0. A null ``doc_id`` is hashed as an empty one and loses ties. Each row that repeats an id or
    a text is scored and ranked for itself. Empty documents give no rows; an empty target makes
    all features of equal frequency there.
    """
    found = head_of(docs, longest, head)
    source = bucket_totals(docs, found, buckets, longest)
    gain = gains(source, bucket_totals(target, found, buckets, longest))
    rows = weighed(docs, found, gain, longest)
    return ranked(rows.withColumn("score", F.col("weight") + gumbel(seed)), share, min_words)


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents that ``resample`` draws, columns unchanged. A row stands for its ``doc_id``: rows that
    share one are kept together if one of them is drawn; null ids are not drawn."""
    ranks = resample(docs, target, **options).where("rank is not null and doc_id is not null")
    return docs.join(ranks.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)


#: The rows of ``resample(documents, benchmark)`` by a SQL engine: CRC-32 byte by byte, once a word.
SQL = f"""
    WITH k AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS k),
    l AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t,
                 0 AS side FROM documents
          UNION ALL
          SELECT NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 1
          FROM benchmark),
    f AS MATERIALIZED (SELECT doc_id, side, unnest(regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM l),
    d AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM f),
    b AS MATERIALIZED (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
               lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
               lambda a, c: xor(a >> 8, k.k[CAST(xor(a, c) & 255 AS BIGINT) + 1])), 4294967295) % {BUCKETS} AS bucket FROM d, k),
    n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN b USING (w) GROUP BY bucket),
    a AS (SELECT sum(s) AS s, sum(t) AS t FROM n),
    g AS (SELECT bucket, CAST(floor(1000 * ln((n.t + 1)::DOUBLE * (a.s + {BUCKETS})::DOUBLE
               / ((n.s + 1)::DOUBLE * (a.t + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain FROM n, a),
    w AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
          FROM f JOIN b USING (w) JOIN g USING (bucket) WHERE side = 0 GROUP BY doc_id),
    r AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                 coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(
                   sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                   / 4294967296::DOUBLE))) AS BIGINT) AS score
          FROM documents LEFT JOIN w USING (doc_id)),
    o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS i FROM r)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN n_features >= {MIN_WORDS} AND i <= (SELECT count(*) FROM r WHERE n_features >= {MIN_WORDS}) * {SHARE} // 100
                THEN i END AS "rank"
    FROM o"""
