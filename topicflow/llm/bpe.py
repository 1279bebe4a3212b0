"""Byte-level BPE of a public vocabulary: frequent words by a transducer, the others by exact merges.

A first pass counts words over all documents and compiles the most frequent ones, with their ids,
into the automaton of ``lexicon``. The second pass cuts each text into words, looks up those that
its task has not met before in the automaton, and merges the rest pair by pair, lowest rank first.
Which words are in the lexicon changes the speed only.
"""

from __future__ import annotations

import heapq
import json
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import map_text, stored
from topicflow.llm.lexicon import Lexicon, compile_lexicon

#: How byte-level tokenizers cut a text before merging (a fixed value of the vocabulary).
CUT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: A space that is not the start of a word: such texts are cut as a whole.
_ODD_SPACE = regex.compile(r" (?=\p{White_Space}|$)")
#: Words of the lexicon at most; a rarer word is merged.
LEXICON_WORDS = 65_536
#: Times that a word of the lexicon stands in the documents at least.
MIN_COUNT = 4
#: Characters between spaces that a task remembers, and the longest such unit that is one.
REMEMBERED, UNIT = 450_000, 64
#: Bytes of a word up to which words are merged side by side in a matrix.
MATRIX_BYTES = 64
#: Bytes of text that are encoded and decoded at a time: arrays of some numbers for each byte are held meanwhile.
AT_ONCE = 500_000
_NONE = np.int64(1) << 62


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merges and special texts of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, alphabet = described["model"], byte_alphabet()
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        vocab = model["vocab"]
        self.tokens = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in vocab.items():
            self.tokens[i] = bytes(alphabet[c] for c in text)
        for text, i in self.special.items():
            self.tokens[i] = text.encode()
        self.first = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.first[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranked = {(vocab[a] << 20 | vocab[b]): (r << 20 | vocab[a + b]) for r, (a, b) in reversed([*enumerate(pairs)])}
        bits = int(np.ceil(np.log2(len(ranked) * 4)))
        self.shift = np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE)
        for key, value in ranked.items():
            slot = int(self._slots(np.array([key]))[0])
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (len(self.keys) - 1)
            self.keys[slot], self.values[slot] = key, value
        self.ranked = ranked

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and new id of each pair as one number; ``_NONE`` where it never merges."""
        key = np.where((a < 0) | (b < 0), -2, a << 20 | b)
        slot = self._slots(key)
        held = self.keys[slot]
        while (wait := (held != key) & (held >= 0)).any():
            slot = np.where(wait, (slot + 1) & (len(self.keys) - 1), slot)
            held = self.keys[slot]
        return np.where(held == key, self.values[slot], _NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words by their merges, and where those of each word start and how many they are."""
        parts: list[np.ndarray] = []
        length = np.fromiter(map(len, words), np.int64, len(words))
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        total, low = 0, 0

        def put(chosen: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
            nonlocal total
            starts[chosen], sizes[chosen] = total + np.cumsum(counts) - counts, counts
            parts.append(ids)
            total += len(ids)

        for width in (8, 12, 16, 24, 32, MATRIX_BYTES):
            chosen = np.flatnonzero((length > low) & (length <= width))
            for begin in range(0, len(chosen), 16384):
                part = chosen[begin : begin + 16384]
                put(part, *self._merge_matrix([words[i] for i in part.tolist()], width))
            low = width
        for i in np.flatnonzero(length > MATRIX_BYTES).tolist():
            ids = np.array(self._merge_long(words[i]), np.int32)
            put(np.array([i]), ids, np.array([len(ids)]))
        return np.concatenate([*parts, np.zeros(0, np.int32)]), starts, sizes

    def _merge_matrix(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        octets = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(-1, width)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        columns = np.arange(width)
        ids = np.where(columns < sizes[:, None], self.first[octets], -1)
        ranks = np.full((len(words), width), _NONE)
        ranks[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
        final = ids.copy()
        live = np.arange(len(words))
        while len(live):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            more = best < _NONE
            final[live[~more]] = ids[~more]
            live, ids, ranks, at, best = live[more], ids[more], ranks[more], at[more], best[more]
            rows = np.arange(len(live))
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, source, 1), np.take_along_axis(ranks, source, 1)
            ids[:, -1], ranks[:, -1] = -1, _NONE
            ids[rows, at] = best & 0xFFFFF
            after, left = np.minimum(at + 1, width - 1), np.maximum(at - 1, 0)
            ranks[rows, at] = np.where(at + 1 < width, self._rank(ids[rows, at], ids[rows, after]), _NONE)
            ranks[rows, left] = np.where(at > 0, self._rank(ids[rows, left], ids[rows, at]), ranks[rows, left])
        kept = final >= 0
        return final[kept].astype(np.int32), kept.sum(axis=1)

    def _merge_long(self, word: bytes) -> list[int]:
        """The same for one long word, with a heap of pairs."""
        ids: list[int] = self.first[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (value := self.ranked.get(ids[i] << 20 | ids[j])) is not None:
                heapq.heappush(heap, (value, i, ids[i], ids[j]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            value, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = value & 0xFFFFF, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]


class Encoder:
    """Ids of texts. Remembers units: what stands between spaces, with the space before it."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special)) or r"(?!)")
        token_bytes = vocabulary.tokens
        self.token_sizes = np.array([len(t) for t in token_bytes], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def units(self, text: str) -> list[str]:
        """Parts of a text whose words are those of the whole text: cut before each space that
        starts a word. Long parts, and texts with other spaces, are cut into their words."""
        if not text:
            return []
        if _ODD_SPACE.search(text):
            return CUT.findall(text)
        first, *rest = text.split(" ")
        out = [first] if first else []
        out += [" " + r for r in rest]
        if len(out) * UNIT < len(text) or max(map(len, out)) > UNIT:
            out = [p for u in out for p in ([u] if len(u) <= UNIT else CUT.findall(u))]
        return out

    def _learn(self, units: list[str]) -> None:
        cut = [CUT.findall(u) for u in units]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        number: dict[str, int] = {}
        place = np.fromiter(
            [number.setdefault(p, len(number)) for ps in cut for p in ps], np.int64, counts.sum()
        )
        words = [p.encode() for p in number]
        found, bounds = self.lexicon.find(words), self.lexicon.offsets
        unseen = np.flatnonzero(found < 0)
        merged, begin, size = self.vocabulary.merge([words[i] for i in unseen.tolist()])
        begins, ends = bounds[np.maximum(found, 0)], bounds[np.minimum(found + 1, len(bounds) - 1)]
        starts, sizes = begins.astype(np.int64), (ends - begins).astype(np.int64)
        starts[unseen], sizes[unseen] = len(self.lexicon.ids) + begin, size
        ids, each = _gather(np.concatenate((self.lexicon.ids, merged)), starts[place], sizes[place])
        edges, last = np.concatenate(([0], np.cumsum(each))), np.cumsum(counts)
        self._add(units, edges[last] - edges[last - counts], ids)

    def _add(self, units: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.index.update(zip(units, range(len(self.index), len(self.index) + len(units))))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.flat = np.concatenate((self.flat, ids.astype(np.int32)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        if len(self.index) > REMEMBERED:
            self._forget()
        parts: list[list[str]] = []
        for text in texts:
            if self.special.search(text):
                at, own = 0, []
                for m in self.special.finditer(text):
                    own += [*self.units(text[at : m.start()]), m[0]]
                    at = m.end()
                parts.append(own + self.units(text[at:]))
                if missing := [s for s in self.vocabulary.special if s not in self.index]:
                    self._add(missing, np.ones(len(missing), np.int64), np.array([self.vocabulary.special[m] for m in missing]))
            else:
                parts.append(self.units(text))
        fresh = set(chain.from_iterable(parts)).difference(self.index)
        if fresh:
            self._learn(list(fresh))
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        place = np.fromiter(map(self.index.__getitem__, chain.from_iterable(parts)), np.int64, counts.sum())
        ids, sizes = _gather(self.flat, self.starts[place], self.sizes[place])
        edges = np.concatenate(([0], np.cumsum(sizes)))
        ends = np.cumsum(counts)
        return ids, edges[ends] - edges[ends - counts]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are no UTF-8 become U+FFFD."""
        flat, sizes = _gather(self.token_flat, self.token_starts[ids], self.token_sizes[ids])
        edges = np.concatenate(([0], np.cumsum(sizes)))
        ends = np.cumsum(counts)
        raw = flat.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(edges[ends - counts].tolist(), edges[ends].tolist())]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``flat[start : start + size]`` of each, one behind another."""
    place = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    place += np.arange(len(place))
    return flat.take(place), sizes


def count_units(docs: DataFrame) -> DataFrame:
    """``unit, n``: what stands between spaces, counted over all documents."""
    units = docs.select(F.explode(F.split("text", " ")).alias("unit"))
    return units.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))


def frequent_units(docs: DataFrame, most: int = LEXICON_WORDS) -> list[str]:
    """The most frequent units of all documents, ``most`` at most, as one list.

    They are those from some count on. The count is read from a histogram of at most some hundred
    steps, so that no more units than are used ever leave the executors.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    common = count_units(docs).where(F.length("unit").between(1, UNIT) & (F.col("n") >= MIN_COUNT))
    common = stored(common.select("unit", step.alias("step")))
    from_step, total = None, 0
    for row in common.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > most:
            break
        from_step = row["step"]
    if from_step is None:
        return []
    return [r.unit for r in common.where(F.col("step") >= from_step).select("unit").collect()]


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, words: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the words in the ``words`` most frequent units of all documents."""
    frequent = sorted({p.encode() for u in frequent_units(docs, words) for p in CUT.findall(" " + u)})
    ids, starts, sizes = vocabulary.merge(frequent)
    spans = zip(frequent, starts.tolist(), (starts + sizes).tolist())
    return compile_lexicon({word: ids[a:b].tolist() for word, a, b in spans})


def encode_decode(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of every row of ``docs`` (``doc_id, text``).

    ``ids`` are those of the vocabulary file at ``path`` without special tokens added around the text;
    texts of special tokens inside it are their ids. ``decoded`` is the text of the ids. Null and
    empty texts have no ids. Rows that repeat are encoded each; other columns are ignored; an empty
    table gives no rows. The file must be at ``path`` on the driver.
    """
    vocabulary = Vocabulary(path)
    spark = docs.sparkSession
    data = spark.sparkContext.broadcast(build_lexicon(docs, vocabulary, lexicon_words))
    shared = spark.sparkContext.broadcast(vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def start():
        encoder = Encoder(shared.value, Lexicon(data.value))

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, counts = encoder.encode(texts)
            edges = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(ids, pa.int32()))
            decoded = pa.array(encoder.decode(ids, counts), pa.string())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, decoded], names=["doc_id", "ids", "decoded"]
            )

        return each

    return map_text(
        docs.select("doc_id", "text"), "text", f"doc_id {kind}, ids array<int>, decoded string", start, AT_ONCE
    )


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what ``encode_decode`` returns."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
