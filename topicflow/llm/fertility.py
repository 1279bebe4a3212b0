"""Quality rules: repetition counts of words and lines, and how well a public vocabulary fits a text.

Fertility is measured with a subword vocabulary that falls back to bytes: characters a token, the
share of tokens that are such bytes, and the entropy of the tokens. Text of a kind the vocabulary
knows lies in a band of each measure; noise, keys, encoded data and endless repetition leave it.
The bands are of the script most letters of the text have, as scripts differ in how many
characters a token covers.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import as_bytes, map_text

#: Words of a repeated window, words of a document at least, and percent of repeated words at most.
WINDOW_WORDS, MIN_WORDS, MAX_REPEATED = 8, 20, 30
#: Words whose tokens a task remembers, and the length beyond which a word is not remembered.
REMEMBERED, LONGEST = 300_000, 200
#: Tokens from which on entropy says something, and the number whose entropy is the most that text
#: of any length is held to.
ENTROPY_TOKENS, ENTROPY_FULL = 60, 512
_SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Where the measures of a script's text lie."""

    chars_low: float
    chars_high: float
    fallback_high: float
    entropy_low: float


#: Fixed values, by script: alphabets take 1.2 to 8 characters a token, syllable and word signs
#: about one, and a script that the vocabulary lacks is bytes throughout, so that it is not
#: rejected for them. Entropy is a share of ``log2(min(tokens, ENTROPY_FULL))``.
BANDS = {
    "Latin": Band(1.2, 8.0, 0.12, 0.66),
    "Cyrillic": Band(1.0, 8.0, 0.15, 0.60),
    "Greek": Band(0.6, 6.0, 0.60, 0.55),
    "Han": Band(0.25, 2.5, 0.95, 0.55),
    "Hiragana": Band(0.3, 2.5, 0.90, 0.55),
    "Hangul": Band(0.3, 2.5, 0.95, 0.55),
    "Other": Band(0.2, 8.0, 1.0, 0.50),
    "None": Band(0.9, 8.0, 0.12, 0.50),
}
_SCRIPTS = {
    name: regex.compile(rf"[\p{{Script={name}}}]") for name in BANDS if name not in ("Other", "None")
}
_LETTER = regex.compile(r"\p{L}")
_LATIN_ONLY = regex.compile(r"[^\x00-ɏ]")


def script_of(text: str) -> str:
    """The script of most letters; ties go to the first in ``BANDS``; ``None`` without letters."""
    if not _LATIN_ONLY.search(text):
        return "Latin" if _LETTER.search(text) else "None"
    letters = len(_LETTER.findall(text))
    if not letters:
        return "None"
    counts = {name: len(p.findall(text)) for name, p in _SCRIPTS.items()}
    best = max(counts, key=lambda n: (counts[n], -list(counts).index(n)))
    return best if 2 * counts[best] >= letters - sum(counts.values()) and counts[best] else "Other"


def repeated_words(words: np.ndarray, window: int = WINDOW_WORDS) -> int:
    """Words in windows that occur twice or more, exactly. ``words`` are numbers of words."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = words.astype(np.int64)
    done = 1
    while done < window:  # codes of windows of ``done`` words, renumbered at each doubling
        step = min(done, window - done)
        pairs = codes[:-step] * (int(codes.max()) + 1) + codes[step:]
        _, codes = np.unique(pairs, return_inverse=True)
        done += step
    again = np.bincount(codes)[codes] > 1
    if not again.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


class Meter:
    """Token counts of texts, word by word, with the words met before remembered as arrays."""

    def __init__(self, model: bytes):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.starts, self.sizes, self.chars = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, np.int32)

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        lists = self.pieces.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.chars = np.concatenate((self.chars, np.fromiter(map(len, texts), np.int64, len(texts))))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(lists), np.int32, sizes.sum())))

    def measure(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """Of each text: words, their characters, repeated words, tokens, byte tokens, entropy in bits."""
        if len(self.index) > REMEMBERED:
            self._forget()
        split = [t.split() for t in texts]
        fresh = set(chain.from_iterable(split)).difference(self.index)
        if fresh:
            self._learn(list(fresh))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        place = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, counts.sum())
        ends = np.cumsum(counts)
        sizes = self.sizes[place]
        offset = np.repeat(self.starts[place] - (np.cumsum(sizes) - sizes), sizes)
        ids = self.flat[offset + np.arange(sizes.sum())]
        sums = np.concatenate(([0], np.cumsum(sizes)))
        tokens = sums[ends] - sums[ends - counts]
        byte = np.concatenate(([0], np.cumsum(self.is_byte[ids])))
        last = np.cumsum(tokens)
        owner = np.repeat(np.arange(len(texts)), tokens)
        _, seen = np.unique(owner * len(self.is_byte) + ids, return_counts=True)
        of = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(_, np.arange(len(texts) + 1) * len(self.is_byte))))
        spread = np.bincount(of, seen * np.log2(seen), len(texts))
        total = np.maximum(tokens, 1)
        chars = np.concatenate(([0], np.cumsum(self.chars[place])))
        return {
            "n_words": counts,
            "word_chars": chars[ends] - chars[ends - counts],
            "n_repeat_words": np.array(
                [repeated_words(place[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist())], np.int64
            ),
            "n_tokens": tokens,
            "n_fallback": byte[last] - byte[last - tokens],
            "entropy": np.maximum(np.log2(total) - spread / total, 0.0),
        }


def measures(docs: DataFrame, model_path: str) -> DataFrame:
    """All counts and measures of every row of ``docs`` (``doc_id, text``); no decision yet.

    Words are runs without ASCII white space; characters are code points. Null texts have no
    words. ``model_path`` is a sentence-piece model on the driver.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def start():
        meter = Meter(model.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = as_bytes(batch, "text")
            found = meter.measure(texts)
            symbols = [len(t) - len(t.translate(None, _SYMBOLS)) for t in texts]
            lines = [duplicate_lines(t) for t in texts]
            scripts = [script_of(t.decode("utf-8", "replace")) for t in texts]
            columns = {
                "doc_id": batch.column("doc_id"),
                **{k: pa.array(v) for k, v in found.items()},
                "n_symbols": pa.array(symbols, pa.int64()),
                "n_dup_lines": pa.array(lines, pa.int64()),
                "script": pa.array(scripts, pa.string()),
            }
            return pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

        return each

    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_fallback"]
    names = ["doc_id", *counts, "entropy", "script"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} bigint' for c in counts)}, entropy double, script string"
    return map_text(docs.select("doc_id", "text"), "text", schema, start)


def _outside(bands: dict[str, Band]) -> Column:
    """Whether a measure is outside its script's band."""
    tests = {
        name: (F.col("chars_per_token") < b.chars_low)
        | (F.col("chars_per_token") > b.chars_high)
        | (F.col("fallback_share") > b.fallback_high)
        | ((F.col("n_tokens") >= ENTROPY_TOKENS) & (F.col("entropy_share") < b.entropy_low))
        for name, b in bands.items()
    }
    out = F.lit(False)
    for name, test in tests.items():
        out = F.when(F.col("script") == name, test).otherwise(out)
    return out


def quality(docs: DataFrame, model_path: str, bands: dict[str, Band] | None = None) -> DataFrame:
    """The measures with ``base_failed`` and ``kept`` for every row of ``docs``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated windows of eight.
    ``kept``: not failed, and inside the bands of the script. Null and empty texts fail. Rows that
    repeat get equal results; other columns are ignored; an empty table gives no rows.
    """
    found = measures(docs, model_path)
    tokens = F.greatest("n_tokens", F.lit(1))
    found = found.withColumns(
        {
            "chars_per_token": F.col("word_chars") / tokens,
            "fallback_share": F.col("n_fallback") / tokens,
            "entropy_share": F.col("entropy")
            / F.log2(F.least(F.greatest("n_tokens", F.lit(2)), F.lit(ENTROPY_FULL))),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED),
        }
    )
    return found.withColumn("kept", ~F.col("base_failed") & ~_outside(bands or BANDS))
