"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """Complete trees of one depth: feature and threshold per inner node, value per leaf."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.3, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.ridge = trees, depth, rate, ridge

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for j, edges in enumerate(self.edges):
            out[:, j] = np.searchsorted(edges, x[:, j], "left")
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        quantiles = np.linspace(0, 1, BINS)[1:-1]
        self.edges = [np.unique(np.quantile(column, quantiles)) for column in x.T]
        b, inner = self.binned(x), (1 << self.depth) - 1
        n, features = b.shape
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        margin = np.full(n, self.start)
        self.feature = np.zeros((self.trees, inner), np.int64)
        self.threshold = np.full((self.trees, inner), BINS, np.int64)
        self.value = np.zeros((self.trees, 1 << self.depth))
        offset = np.arange(features) * BINS
        for tree in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                cell = ((node - first)[:, None] * features * BINS + offset + b).ravel()
                size = width * features * BINS
                g = np.bincount(cell, np.repeat(gradient, features), size).reshape(width, features, BINS)
                h = np.bincount(cell, np.repeat(weight, features), size).reshape(width, features, BINS)
                left_g, left_h = g.cumsum(2), h.cumsum(2)
                all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
                gain = (
                    left_g**2 / (left_h + self.ridge)
                    + (all_g - left_g) ** 2 / (all_h - left_h + self.ridge)
                    - all_g**2 / (all_h + self.ridge)
                ).reshape(width, -1)
                best = gain.argmax(1)
                split = gain[np.arange(width), best] > 1e-6
                at = first + np.arange(width)
                self.feature[tree, at] = best // BINS
                self.threshold[tree, at] = np.where(split, best % BINS, BINS)
                node = 2 * node + 1 + (b[np.arange(n), self.feature[tree, node]] > self.threshold[tree, node])
            leaf = node - inner
            g = np.bincount(leaf, gradient, 1 << self.depth)
            h = np.bincount(leaf, weight, 1 << self.depth)
            self.value[tree] = self.rate * g / (h + self.ridge)
            margin += self.value[tree][leaf]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        b, inner = self.binned(x), (1 << self.depth) - 1
        n = len(b)
        flat, row, out = b.ravel(), np.arange(n) * b.shape[1], np.full(n, self.start)
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(n, np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (flat[row + feature[node]] > threshold[node])
            out += value[node - inner]
        return out
