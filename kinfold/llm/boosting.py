"""Histogram gradient-boosted trees in numpy, flattened into arrays for level-by-level traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class TreeParams:
    rounds: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.2
    ridge: float = 1.0
    least_weight: float = 1.0


@dataclass
class Trees:
    """Node i of a tree has children 2i + 1 and 2i + 2; leaves are the last level."""

    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # (trees, inner nodes); larger values go right
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, p: TreeParams) -> Trees:
    """Logistic loss; each round grows one full-depth tree on histograms of gradients over quantile bins."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, p.bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    raw = np.full(n, base)
    inner, leaves = 2**p.depth - 1, 2**p.depth
    features, cuts, values = [], [], []
    for _ in range(p.rounds):
        score = 1.0 / (1.0 + np.exp(-raw))
        grad, hess = score - y, score * (1 - score)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(p.depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            gain = np.full((count, width), -np.inf)
            place = np.zeros((count, width), np.int64)
            for j in range(width):
                slots = len(edges[j]) + 1
                if slots < 2:
                    continue
                key = local * slots + binned[:, j]
                g = np.bincount(key, grad, count * slots).reshape(count, slots).cumsum(axis=1)
                h = np.bincount(key, hess, count * slots).reshape(count, slots).cumsum(axis=1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                won = gl**2 / (hl + p.ridge) + (gt - gl) ** 2 / (ht - hl + p.ridge) - gt**2 / (ht + p.ridge)
                won[(hl < p.least_weight) | (ht - hl < p.least_weight)] = -np.inf
                place[:, j] = won.argmax(axis=1)
                gain[:, j] = won[np.arange(count), place[:, j]]
            best = gain.argmax(axis=1)
            for k in range(count):
                if gain[k, best[k]] > 1e-9:
                    feature[first + k] = best[k]
                    cut[first + k] = edges[best[k]][place[k, best[k]]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        at = node - inner
        value = -p.rate * np.bincount(at, grad, leaves) / (np.bincount(at, hess, leaves) + p.ridge)
        raw += value[at]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Trees(np.array(features), np.array(cuts), np.array(values), base)
