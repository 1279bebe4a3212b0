"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its different words and the beginnings of its words, hashed. A linear weight
says how much a term counts alone, and the product of two terms' vectors how much it counts that they
stand in one text. The model is fitted on the driver on a bounded sample of labelled rows, and
holds only the terms that kept a weight; scoring is one pass over the documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import map_text

#: Labelled rows of each class in the sample, about: of a larger class, as many by a hash of the id.
SAMPLE = 4000
#: Letters of the word beginnings that are terms.
PREFIXES = (4, 5, 6)
#: Terms that the machine weighs at most, those that tell the classes apart best. Each is in
#: ``MIN_TEXTS`` texts of the sample at least, with a chi-square that chance gives to one in 2000.
MAX_TERMS, MIN_TEXTS, MIN_CHI = 30_000, 3, 12.0
FACTORS = 4
EPOCHS, BATCH, STEP = 20, 500, 0.15
#: Shrinks: of linear weights towards zero (absolute), of vectors (squared).
L1, L2 = 2e-4, 1e-4
THRESHOLD = 0.3
SEED = 7
#: Words whose terms a task remembers.
REMEMBERED = 300_000
_WORD = re.compile(r"\w+")


def terms_of_word(word: str) -> list[int]:
    """Hashes of a word and of its beginnings, signed 32-bit."""
    cut = {word[:n] for n in PREFIXES if len(word) > n}
    raw = [xxhash.xxh32_intdigest(b"w" + word.encode()), *(xxhash.xxh32_intdigest(b"p" + c.encode()) for c in cut)]
    return [h - (1 << 32) if h >= 1 << 31 else h for h in raw]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class Machine:
    """``rows`` numbers the terms; ``weights`` and ``vectors`` are by number."""

    bias: float
    rows: dict[int, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))

    def logit(self, rows: list[int]) -> float:
        v = self.vectors[rows]
        return float(self.bias + self.weights[rows].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum()))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(size: int, of: int, seed: int) -> Column:
    """Picks about ``size`` of ``of`` rows by a hash of their ``doc_id``, all if they are no more."""
    share = round((1 << 30) * min(1.0, size / max(of, 1)))
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < share


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of the sampled texts behind one another, terms a text, labels, and weights of the rows."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    each = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    counts = {r.toxic: r.n for r in each.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for label in (True, False):
        part = each.where((F.col("toxic") == label) & sampled(size, counts.get(label, 0), SEED))
        chosen = part if chosen is None else chosen.union(part)
    # the sample has about 2 * size rows of two columns at most
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def start():
        def each_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = [
                sorted({t for w in words_of(x or "") for t in terms_of_word(w)}) for x in batch.column("text").to_pylist()
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(lists, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "terms"],
            )

        return each_batch

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = map_text(picked, "text", f"doc_id {kind}, toxic boolean, terms array<int>", start).toArrow()
    found = found.sort_by("doc_id").combine_chunks()
    lists = found.column("terms").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    toxic = found.column("toxic").to_numpy().astype(float)
    weight = np.where(
        toxic > 0,
        counts.get(True, 0) / max(1, (toxic > 0).sum()),
        counts.get(False, 0) / max(1, (toxic == 0).sum()),
    )
    return flat, sizes, toxic, weight / max(weight.mean(), 1e-9) if len(weight) else weight


def _informative(flat: np.ndarray, owner: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The terms to weigh, by how far their share of toxic texts is from that of all (chi-square)."""
    terms, number = np.unique(flat, return_inverse=True)
    texts = np.bincount(number, minlength=len(terms))
    toxic = np.bincount(number, weights=y[owner], minlength=len(terms))
    share = y.mean() if len(y) else 0.0
    chi = (toxic - texts * share) ** 2 / np.maximum(texts * share * (1 - share), 1e-9)
    order = np.lexsort((terms, -chi))
    good = (texts >= MIN_TEXTS) & (chi >= MIN_CHI)
    return terms[order[good[order]][:MAX_TERMS]]


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Machine:
    """The machine of about ``size`` labelled rows of each class at most that are not held out.

    With no label, or labels of one class, every text gets the score of the bias alone.
    """
    flat, sizes, y, weight = _sample(docs, labels, size)
    rate = float((y * weight).sum() / max(weight.sum(), 1e-9)) if len(y) else 0.0
    bias = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    if not 0 < y.sum() < len(y):
        return Machine(bias)
    owner = np.repeat(np.arange(len(y)), sizes)
    terms = _informative(flat, owner, y)
    if not len(terms):
        return Machine(bias)
    rank = np.argsort(terms)
    at = np.searchsorted(terms[rank], flat)
    at = np.minimum(at, len(terms) - 1)
    number = rank[at]
    used = terms[number] == flat
    number, owner = number[used], owner[used]
    edges = np.searchsorted(owner, np.arange(len(y) + 1))

    random = np.random.default_rng(SEED)
    w, v = np.zeros(len(terms)), random.normal(0, 0.02, (len(terms), FACTORS))
    gw, gv, gb = np.full(len(terms), 1e-6), np.full((len(terms), FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = random.permutation(len(y))
        for begin in range(0, len(y), BATCH):
            rows = order[begin : begin + BATCH]
            counts = edges[rows + 1] - edges[rows]
            place = np.repeat(edges[rows] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            ids, text = number[place], np.repeat(np.arange(len(rows)), counts)
            sums = np.stack([np.bincount(text, v[ids, f], len(rows)) for f in range(FACTORS)], axis=1)
            squares = np.bincount(text, (v[ids] ** 2).sum(1), len(rows))
            logit = bias + np.bincount(text, w[ids], len(rows)) + 0.5 * ((sums**2).sum(1) - squares)
            slope = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) * weight[rows] / len(rows)
            gb += slope.sum() ** 2
            bias -= STEP * slope.sum() / np.sqrt(gb)
            touched, inverse = np.unique(ids, return_inverse=True)
            d = np.bincount(inverse, slope[text], len(touched))
            gw[touched] += d**2
            rate_w = STEP / np.sqrt(gw[touched])
            moved = w[touched] - rate_w * d
            w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - rate_w * L1, 0)
            for f in range(FACTORS):
                pull = np.bincount(inverse, slope[text] * sums[text, f], len(touched)) - d * v[touched, f]
                pull += L2 * v[touched, f]
                gv[touched, f] += pull**2
                v[touched, f] -= 0.1 * STEP * pull / np.sqrt(gv[touched, f])
    kept = np.flatnonzero((w != 0) | (np.abs(v).max(axis=1) > 0.05))
    return Machine(bias, {int(t): i for i, t in enumerate(terms[kept])}, w[kept], v[kept])


def with_score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with a column ``_toxicity_score`` from 0 to 1; one of that name is replaced.

    Null and empty texts get the score of the bias. Each row is scored for itself, so rows that
    repeat get equal scores; other columns pass through; an empty table gives no rows.
    """
    docs = docs.drop("_toxicity_score")
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def start():
        machine = shared.value

        class Rows(dict):
            def __missing__(self, word: str) -> tuple[int, ...]:
                if len(self) >= REMEMBERED:
                    self.clear()
                found = tuple(machine.rows[t] for t in terms_of_word(word) if t in machine.rows)
                self[word] = found
                return found

        rows = Rows()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            logits = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = {r for found in map(rows.__getitem__, words_of(text or "")) if found for r in found}
                logits[i] = machine.logit(sorted(own))
            scores = pa.array(1 / (1 + np.exp(-np.clip(logits, -30, 30))))
            return pa.RecordBatch.from_arrays(
                [*batch.columns, scores], names=[*batch.schema.names, "_toxicity_score"]
            )

        return each

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_text(docs, "text", f"{schema}, _toxicity_score double", start)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``, by ``with_score``."""
    scored = with_score(docs.select("doc_id", "text"), machine)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_toxicity_score").alias("score"),
        (F.col("_toxicity_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs`` with a score below ``THRESHOLD``, columns unchanged."""
    return with_score(docs, machine).where(F.col("_toxicity_score") < THRESHOLD).select(*docs.columns)
