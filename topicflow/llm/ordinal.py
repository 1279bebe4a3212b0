"""Quality grades by ordinal regression: one set of hashed-text weights, ordered thresholds.

The chance of a grade of at most k is the logistic function of threshold k less the text's value.
Thresholds rise by construction, so the chances of the grades are never negative. The value is a
sum of weights of the text's hashed words and word shapes, each by the root of its share.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import as_bytes, map_text
from topicflow.llm.toxicity import held_out, sampled

#: Labelled rows of each grade in the sample, about: of a larger grade, as many by a hash of the id.
SAMPLE = 3000
#: Weights, as a power of two.
BITS = 18
EPOCHS, BATCH, STEP, L2 = 12, 200, 0.5, 1e-5
SEED = 5
#: Chance of grade 1 or better from which on a document is selected.
SELECT = 0.5
REMEMBERED = 300_000


def shape(word: bytes) -> str:
    """A word as kinds of characters, runs as two: ``THE!!`` is ``XX!!``."""
    text = word.decode("utf-8", "replace")
    kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in text[:40])
    return re.sub(r"(.)\1+", r"\1\1", kinds, flags=re.DOTALL)


class Hasher:
    """Term counts of texts: hashed words and shapes, and how often words come again."""

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.word, self.shape = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def terms(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and value of each term of each text."""
        if len(self.index) > REMEMBERED:
            self._forget()
        split = [t.split() for t in texts]
        fresh = list(set(chain.from_iterable(split)).difference(self.index))
        if fresh:
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
            code = lambda s: xxhash.xxh32_intdigest(s) >> (32 - BITS)
            self.word = np.concatenate((self.word, [code(b"w" + w.lower()) for w in fresh]))
            self.shape = np.concatenate((self.shape, [code(b"s" + shape(w).encode()) for w in fresh]))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        place = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, counts.sum())
        owner = np.repeat(np.arange(len(texts)), counts)
        keys = np.concatenate((owner << BITS | self.word[place], owner << BITS | self.shape[place]))
        key, seen = np.unique(keys, return_counts=True)
        total = np.maximum(2 * counts, 1)
        value = np.sqrt(seen / total[key >> BITS])
        # words that stand right after themselves, and lines that come again, in tenths
        same = np.bincount(owner[1:], (place[1:] == place[:-1]) & (owner[1:] == owner[:-1]), len(texts))
        lines = [t.split(b"\n") for t in texts]
        again = np.array([1 - len(set(x)) / len(x) for x in lines])
        bins = np.stack((np.minimum(10 * same / np.maximum(counts, 1), 9), np.minimum(10 * again, 9), np.minimum(np.log2(counts + 1), 15)))
        names = np.array([[xxhash.xxh32_intdigest(f"{kind}{b}".encode()) >> (32 - BITS) for b in range(16)] for kind in ("after", "lines", "long")])
        extra = names[np.arange(3)[:, None], bins.astype(np.int64)]
        texts_at = np.tile(np.arange(len(texts)), 3)
        return np.concatenate((key >> BITS, texts_at)), np.concatenate((key & ((1 << BITS) - 1), extra.reshape(-1))), np.concatenate((value, np.full(texts_at.size, 0.3)))


@dataclass
class Grader:
    """``thresholds`` rise; there is one more grade than thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, values: np.ndarray) -> np.ndarray:
        """The chance of each grade from 1 on, or a better one."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - values[:, None], -30, 30)))


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, grade``: 0 poor, 1 good but toxic, 2 good; documents without a quality have none."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def fit(docs: DataFrame, grades: DataFrame, size: int = SAMPLE) -> Grader:
    """The regression on about ``size`` rows at most of each grade of ``grades`` that are not held out.

    Without a graded row, or with one grade only, every text gets the same grade.
    """
    each = grades.where(~held_out())
    counts = {r.grade: r.n for r in each.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    top = max(counts, default=0)
    if len(counts) < 2:
        return Grader(np.zeros(1 << BITS), np.where(np.arange(1, max(top, 1) + 1) <= top, -4.0, 4.0))
    chosen = None
    for grade in sorted(counts):
        part = each.where((F.col("grade") == grade) & sampled(size, counts[grade], SEED))
        chosen = part if chosen is None else chosen.union(part)
    # about size rows of each grade, of two columns
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def start():
        hasher = Hasher()

        def terms(batch: pa.RecordBatch) -> pa.RecordBatch:
            owner, term, value = hasher.terms(as_bytes(batch, "text"))
            order = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[order], np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x[order].astype(t))) for x, t in ((term, np.int32), (value, np.float32))]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), *lists], names=["doc_id", "grade", "terms", "values"])

        return terms

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_text(picked, "text", f"doc_id {kind}, grade int, terms array<int>, values array<float>", start).toArrow()
    rows = rows.sort_by("doc_id").combine_chunks()
    y = rows.column("grade").to_numpy()
    lists = rows.column("terms").combine_chunks()
    edges, term = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    edges = edges - edges[0] if len(edges) else edges
    value = rows.column("values").combine_chunks().flatten().to_numpy().astype(float)
    share = {g: max(1, (y == g).sum()) for g in counts}
    weight = np.array([counts[g] / share[g] for g in y.tolist()])
    weight /= weight.mean()

    random = np.random.default_rng(SEED)
    w, gw = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    below = np.array([(weight * (y <= k)).sum() / weight.sum() for k in range(top)]).clip(1e-3, 1 - 1e-3)
    theta = np.log(below / (1 - below))
    theta = np.maximum.accumulate(theta + np.arange(top) * 1e-3)
    gt = np.full(top, 1e-8)
    for _ in range(EPOCHS):
        order = random.permutation(len(y))
        for begin in range(0, len(y), BATCH):
            r = order[begin : begin + BATCH]
            n = edges[r + 1] - edges[r]
            place = np.repeat(edges[r] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            text, ids, x = np.repeat(np.arange(len(r)), n), term[place], value[place]
            z = np.bincount(text, w[ids] * x, len(r))
            # cumulative chances at both thresholds of each row's grade
            edge = np.concatenate(([-np.inf], theta, [np.inf]))
            up, low = edge[y[r] + 1] - z, edge[y[r]] - z
            p_up, p_low = 1 / (1 + np.exp(-np.clip(up, -30, 30))), 1 / (1 + np.exp(-np.clip(low, -30, 30)))
            d_up, d_low = p_up * (1 - p_up), p_low * (1 - p_low)
            chance = np.maximum(p_up - p_low, 1e-9)
            scale = weight[r] / len(r)
            slope = scale * (d_up - d_low) / chance
            touched, inverse = np.unique(ids, return_inverse=True)
            g = np.bincount(inverse, slope[text] * x, len(touched)) + L2 * w[touched]
            gw[touched] += g**2
            w[touched] -= STEP * g / np.sqrt(gw[touched])
            for k in range(top):
                g = -(scale * d_up / chance)[y[r] == k].sum() + (scale * d_low / chance)[y[r] == k + 1].sum()
                gt[k] += g**2
                theta[k] -= 0.1 * g / np.sqrt(gt[k])
            theta = np.maximum.accumulate(theta + np.arange(top) * 1e-9)
    return Grader(w, theta)


def grade(docs: DataFrame, grader: Grader) -> DataFrame:
    """``doc_id, held_out, expected_grade, tails, selected`` of every row of ``docs`` (``doc_id, text``).

    ``tails`` are the chances of each grade from 1 on or a better one. Null and empty texts are texts
    without words. Rows that repeat get equal grades; other columns are ignored; an empty table
    gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(grader)

    def start():
        hasher, grader = Hasher(), shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            owner, term, value = hasher.terms(as_bytes(batch, "text"))
            tails = grader.tails(np.bincount(owner, grader.weights[term] * value, batch.num_rows))
            edges = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tails.shape[1])
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tails.sum(1)), pa.ListArray.from_arrays(edges, pa.array(tails.reshape(-1)))],
                names=["doc_id", "expected_grade", "tails"],
            )

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_text(docs.select("doc_id", "text"), "text", f"doc_id {kind}, expected_grade double, tails array<double>", start)
    return out.select(
        "doc_id", held_out().alias("held_out"), "expected_grade", "tails", (F.element_at("tails", 1) >= SELECT).alias("selected")
    )
