"""Documents as token ids in compressed binary files, in ascending ``doc_id`` order.

Documents are dealt to tasks by ranges of their ids and sorted there. A task encodes them and
closes a shard (``repair``) whenever it holds ``SHARD_IDS`` ids, so its memory does not follow the
size of its range. Spark's own writer puts the shards into files, one behind another, so a lost task
leaves nothing behind.

Ids are those of the ``tokenizers`` library. Parts of texts between spaces that begin words are merged
by the same vocabulary file once and remembered, which is several times as fast as the library; texts with
special tokens go to the library itself.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topicflow.llm import repair
from topicflow.llm.bpe import CUT, Vocabulary
from topicflow.llm.common import parallelism, parts_between_spaces, slices, stored
from topicflow.storage import shared_scratch

#: Ids of a shard: it closes with the document that reaches them.
SHARD_IDS = 1 << 20
#: Shards of a file.
FILE_SHARDS = 32
#: Parts that a worker remembers, and the longest one that is remembered, in characters.
REMEMBERED, UNIT = 800_000, 64
#: The id behind each document.
END = 0


class Encoder:
    """Ids of texts as little-endian 32-bit numbers.

    Texts that hold a special token are given to the library. Others are cut where its pre-tokenizer always
    cuts, before a space that begins a word. Distinct parts of many texts are looked up once, and what they are
    merged to is remembered.
    """

    def __init__(self, described: str, vocabulary: Vocabulary):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.vocabulary = Tokenizer.from_str(described), vocabulary
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.token_sizes = np.array([len(t) for t in vocabulary.tokens], np.int64)
        # where merges make ids in ascending order, as here, an id is the rank of its bytes
        in_order = len({(v & 0xFFFFF) - (v >> 20) for v in vocabulary.ranked.values()}) == 1
        ranks = {t: i for i, t in enumerate(vocabulary.tokens) if i not in vocabulary.special.values()}
        self.ranked = tiktoken.Encoding("ranks", pat_str=CUT.pattern, mergeable_ranks=ranks, special_tokens={}) if in_order else None
        self._forget()

    def _forget(self) -> None:
        #: Number of a part behind a space; where its ids stand in ``flat`` and how many they are, -1 if it begins no word.
        self.after_space: dict[str, int] = {"": 0}
        self.starts, self.sizes, self.flat = np.zeros(1, np.int64), np.full(1, -1, np.int64), np.zeros(0, np.uint32)
        #: Ids of the parts that texts begin with.
        self.parts: dict[str, bytes] = {}

    def _merged(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that are cut like texts of their own, by exact merges, and how many each has."""
        cut = [CUT.findall(p) for p in parts]
        number: dict[str, int] = {}
        place = np.array([number.setdefault(w, len(number)) for words in cut for w in words], np.int64)
        flat, starts, sizes = self.vocabulary.merge([w.encode() for w in number])
        ids = repair.gather(flat, starts[place], sizes[place])
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes[place])))
        return ids, np.diff(ends[np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))], prepend=0)

    def _spaced(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts that stand behind a space and begin a word: together they are cut like one text."""
        text = " " + " ".join(parts)
        if not self.ranked:
            return self._merged([" " + p for p in parts])
        try:
            ids = self.ranked.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # white space that its pattern cannot hold
            return self._merged([" " + p for p in parts])
        ends = np.cumsum(self.token_sizes[ids])
        octets = np.cumsum(pc.binary_length(pa.array(parts, pa.large_string())).to_numpy() + 1)
        # the number of the last id that ends with each part
        last = np.zeros(int(octets[-1]) + 1, bool)
        last[octets] = True
        return ids, np.diff(np.flatnonzero(last[ends]) + 1, prepend=0)

    def _learn(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts behind spaces, and how many each has (-1 if it begins no word); short ones are remembered."""
        odd = {i for i, p in enumerate(fresh) if not p or p[0].isspace()}
        words = [p for i, p in enumerate(fresh) if i not in odd] if odd else fresh
        ids, each = self._spaced(words) if words else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        return ids.astype(np.uint32), np.insert(each, [i - n for n, i in enumerate(sorted(odd))], -1)

    def _remember(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.after_space.update(zip(parts, range(len(self.after_space), len(self.after_space) + len(parts))))
        each = np.maximum(sizes, 0)
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(each) - each))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.flat = np.concatenate((self.flat, ids))

    def _found(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each part behind a space start and how many they are."""
        number = np.fromiter(map(self.after_space.get, parts, repeat(-1)), np.int64, len(parts))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            length = np.fromiter(map(len, map(parts.__getitem__, fresh.tolist())), np.int64, len(fresh))
            short, long = fresh[length <= UNIT], fresh[length > UNIT]
            asked = list(map(parts.__getitem__, short.tolist()))
            self._remember(asked, *self._learn(asked))
            number[short] = np.arange(len(self.after_space) - len(asked), len(self.after_space))
        starts, sizes, flat = self.starts.take(number, mode="clip"), self.sizes.take(number, mode="clip"), self.flat
        if len(fresh) and len(long):  # these are not remembered
            ids, sizes[long] = self._learn([parts[i] for i in long.tolist()])
            each = np.maximum(sizes[long], 0)
            starts[long] = len(flat) + np.cumsum(each) - each
            flat = np.concatenate((flat, ids))
        return flat, starts, sizes

    def _first(self, parts: list[str]) -> list[bytes]:
        """The ids of parts that texts begin with."""
        fresh = list(set(parts).difference(self.parts))
        found = dict(zip(fresh, _parted(*self._merged(fresh))))
        self.parts.update((p, ids) for p, ids in found.items() if len(p) <= UNIT)
        return [found[p] if p in found else self.parts[p] for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if len(self.after_space) + len(self.parts) > REMEMBERED:
            self._forget()
        special = self.vocabulary.special
        whole = {i for i, t in enumerate(texts) if any(s in t for s in special)}
        place, parts, edges = parts_between_spaces(["" if i in whole else t for i, t in enumerate(texts)])
        flat, starts, sizes = self._found(parts)
        heads = self._first([parts[i] for i in place[edges[:-1]].tolist()])
        sizes = np.append(sizes, 0)
        place[edges[:-1]] = len(parts)  # what a text begins with is in heads
        odd = np.flatnonzero(sizes[place] < 0)  # spaces that begin no word
        merged = set((np.searchsorted(edges, odd, "right") - 1).tolist())
        sizes = np.maximum(sizes, 0)[place]
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))[edges]
        rests = _parted(repair.gather(flat, np.append(starts, 0)[place], sizes), np.diff(ends))
        out = []
        for i, text in enumerate(texts):
            if i in whole:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            elif i in merged:
                out.append(_parted(*self._merged([text]))[0])
            else:
                out.append(heads[i] + rests[i])
        return out


def _parted(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw, edges = ids.astype("<u4").tobytes(), [0, *(4 * np.cumsum(sizes)).tolist()]
    return [raw[a:b] for a, b in zip(edges, edges[1:])]


_encoders: dict[str, Encoder] = {}


def _encoder(described: str, vocabulary: Vocabulary) -> Encoder:
    """The encoder of this Python worker, which keeps what earlier tasks remembered."""
    key = hashlib.sha256(described.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(described, vocabulary)
    return _encoders[key]


def _in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in ranges of ascending ids, sorted; null ids first.

    Rows of one id follow one another by a hash of their texts, so that an id of very many rows
    is dealt to several ranges, and copies by where they were read.
    """
    keys = ["doc_id", "_hash", "_row"]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ranged = rows.repartitionByRange(parallelism(docs.sparkSession), *keys).sortWithinPartitions(*keys)
    return ranged.select("doc_id", "text")


def write(docs: DataFrame, path: str, tokenizer: str, end: int | None = END, shard_ids: int = SHARD_IDS) -> None:
    """Write ``docs`` (``doc_id, text``) as token files in the new directory ``path``.

    ``tokenizer`` is the path, on the driver, of a tokenizer file of the byte-level kind; special tokens
    are not added, those in a text are their ids. ``end`` is put behind each document (None: nothing).
    Null and empty texts have no ids of their own. A text of any length is one document of one shard, which
    its task holds in memory. Documents stand in ascending order of their integer ``doc_id``, null ids first;
    rows that repeat are stored each. Other columns are ignored. An empty table gives a
    directory without shards.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast((file.read(), Vocabulary(tokenizer)))
    behind = b"" if end is None else np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, made = _encoder(*shared.value), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        encoded: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal made, held
            sizes = np.array([len(e) // 4 for e in encoded], np.int64)
            flat = np.frombuffer(b"".join(encoded), "<u4").astype(np.int64)
            data = repair.write_shard(part, made, ids, sizes, flat)
            ids.clear()
            encoded.clear()
            made, held = made + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                ids.append(doc_id)
                encoded.append(own + behind)
                held += len(encoded[-1]) // 4
                if held >= shard_ids:
                    yield close()
        if ids:
            yield close()

    made = _in_order(docs).mapInArrow(run, "data binary")
    # Spark's text writer writes the bytes of a value as they are, and a line end behind them
    writer = made.select(F.col("data").cast("string").alias("value")).write
    writer.option("maxRecordsPerFile", FILE_SHARDS).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _read(spark: SparkSession, path: str, schema: str, each) -> DataFrame:
    """Rows that ``each`` makes of every shard: a record batch a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for shard in repair.shards(content.as_buffer()):
                    yield each(shard)

    return _files(spark, path).mapInArrow(run, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``part, shard, nth, doc_id, ids`` of every stored document: where it stands, and its ids."""

    def each(shard: repair.Shard) -> pa.RecordBatch:
        n = len(shard.doc_ids)
        edges = pa.array(np.concatenate(([0], shard.ends)).astype(np.int64))
        lists = pa.LargeListArray.from_arrays(edges, pa.array(shard.ids().astype(np.int32))).cast(pa.list_(pa.int32()))
        place = [pa.array(np.full(n, x, np.int64)) for x in (shard.part, shard.shard)]
        columns = [*place, pa.array(np.arange(n)), pa.array(shard.doc_ids, pa.int64()), lists]
        return pa.RecordBatch.from_arrays(columns, names=["part", "shard", "nth", "doc_id", "ids"])

    return _read(spark, path, "part bigint, shard bigint, nth bigint, doc_id bigint, ids array<int>", each)


def read_some(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of the documents asked for. Of the shards that hold one, only the symbols
    around it are decoded."""
    asked = set(doc_ids)

    def each(shard: repair.Shard) -> pa.RecordBatch:
        found = [(i, shard.document(n).tolist()) for n, i in enumerate(shard.doc_ids) if i in asked]
        columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids"])

    return _read(spark, path, "doc_id bigint, ids array<int>", each)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, from the files.

    ``start`` counts the ids of all documents before it. Ids are added up a shard, then a part: the
    driver sees one number for each part.
    """

    def each(shard: repair.Shard) -> pa.RecordBatch:
        ids, ends = shard.ids().astype("<u4"), shard.ends
        begins = np.concatenate((np.zeros(min(1, len(ends)), np.int64), ends[:-1]))
        raw = memoryview(ids.tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
        n = len(ends)
        place = [pa.array(np.full(n, x, np.int64)) for x in (shard.part, shard.shard)]
        columns = [
            *place, pa.array(shard.doc_ids, pa.int64()), pa.array(begins),
            pa.array(ends - begins, pa.int64()), pa.array(crc, pa.int64()),
        ]
        names = ["part", "shard", "doc_id", "begin", "n_tokens", "ids_crc32"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part bigint, shard bigint, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint"
    rows = stored(_read(spark, path, schema, each))
    sums = rows.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("part").orderBy("shard")) - F.col("n")
    starts = stored(sums.withColumn("before", before))
    totals = starts.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    ends = np.cumsum([0, *(r.n for r in totals)]).tolist()
    table = pa.table({"part": pa.array([r.part for r in totals], pa.int64()), "base": pa.array(ends[:-1], pa.int64())})
    based = starts.join(spark.createDataFrame(table), "part").select("part", "shard", (F.col("base") + F.col("before")).alias("base"))
    found = rows.join(based, ["part", "shard"])
    return found.select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """``digests`` of the files that ``write`` makes of ``docs`` (at ``path``, or in the shared folder)."""
    path = path or f"{shared_scratch(docs.sparkSession)}/tokens"
    write(docs, path, tokenizer)
    return digests(docs.sparkSession, path)


