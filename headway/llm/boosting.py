"""Gradient-boosted regression trees on binned features, for two classes."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Log-odds from a sum of trees; all trees have the same depth, kept as arrays."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, least: float = 8.0):
        self.trees, self.depth, self.rate, self.least = trees, depth, rate, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        n, features = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(features)]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1)
        share = y.mean()
        self.start = float(np.log(share / (1 - share)))
        score = np.full(n, self.start)
        self.feature, self.cut, self.leaf = [], [], []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(n, dtype=np.int64)
            feature, cut = [], []
            for level in range(self.depth):
                width = 1 << level
                best = np.full(width, 1e-9)
                f_best, c_best = np.zeros(width, np.int64), np.full(width, np.inf)
                b_best = np.full(width, BINS)
                for f in range(features):
                    if not len(self.edges[f]):
                        continue
                    cell = node * BINS + binned[:, f]
                    g = np.bincount(cell, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    h = np.bincount(cell, hessian, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    left, right = h[:, :-1], h[:, -1:] - h[:, :-1]
                    gain = (
                        g[:, :-1] ** 2 / (left + 1)
                        + (g[:, -1:] - g[:, :-1]) ** 2 / (right + 1)
                        - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                    )
                    gain[:, len(self.edges[f]) :] = 0
                    gain[(left < self.least / 4) | (right < self.least / 4)] = 0
                    at = gain.argmax(axis=1)
                    value = gain[np.arange(width), at]
                    better = value > best
                    best[better], f_best[better], b_best[better] = value[better], f, at[better]
                    c_best[better] = self.edges[f][at[better]]
                feature.append(f_best)
                cut.append(c_best)
                node = node * 2 + (binned[np.arange(n), f_best[node]] > b_best[node])
            leaves = 1 << self.depth
            value = np.bincount(node, gradient, leaves) / (np.bincount(node, hessian, leaves) + 1)
            value *= self.rate
            score += value[node]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(value)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for f, c in zip(feature, cut, strict=True):
                node = node * 2 + (x[rows, f[node]] > c[node])
            score += leaf[node]
        return score
