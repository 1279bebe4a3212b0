"""Gradient-boosted trees for a yes-or-no label, on histograms of quantile bins."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, BINS, RATE, SHRINK = 60, 4, 32, 0.2, 1.0


@dataclass
class Forest:
    """Trees of one depth: the feature and bin of each split, heap order, and the leaves' logits."""

    bias: float
    edges: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1).astype(np.uint8)

    def logit(self, x: np.ndarray) -> np.ndarray:
        bins, rows = self.binned(x), np.arange(len(x))
        total = np.full(len(x), self.bias)
        for feature, cut, leaf in zip(self.feature, self.bin, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (bins[rows, feature[at]] > cut[at])
            total += leaf[at - len(feature)]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Newton boosting of the logistic loss; every tree is full, a useless split sends all rows left."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    forest = Forest(float(np.log(rate / (1 - rate))), edges, *(np.zeros(0),) * 3)
    bins = forest.binned(x).astype(np.int64)
    score = np.full(len(y), forest.bias)
    inner, features, cuts, leaves = 2**DEPTH - 1, [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, n = 2**level - 1, 2**level
            best = np.full(n, 1e-6)
            local = at - first
            for j in range(x.shape[1]):
                code = local * BINS + bins[:, j]
                gl = np.bincount(code, g, n * BINS).reshape(n, BINS).cumsum(1)
                hl = np.bincount(code, h, n * BINS).reshape(n, BINS).cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt**2 / (ht + SHRINK)
                where = gain.argmax(1)
                top = gain[np.arange(n), where]
                better = top > best
                best[better] = top[better]
                feature[first : first + n][better], cut[first : first + n][better] = j, where[better]
            at = 2 * at + 1 + (bins[np.arange(len(y)), feature[at]] > cut[at])
        local = at - inner
        leaf = RATE * np.bincount(local, g, inner + 1) / (np.bincount(local, h, inner + 1) + SHRINK)
        score += leaf[local]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    forest.feature, forest.bin, forest.leaf = np.array(features), np.array(cuts), np.array(leaves)
    return forest
