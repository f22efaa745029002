"""Gradient-boosted regression trees for two classes, small enough to be sent to every worker."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of a fixed depth, fitted to the logistic loss by Newton steps over binned features."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, smallest: int = 8):
        self.rounds, self.depth, self.rate, self.bins, self.smallest = rounds, depth, rate, bins, smallest
        self.base = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(mean / (1 - mean)))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, edges, y - p, p * (1 - p) + 1e-6)
            self.trees.append(tree)
            score += tree[2][leaf]
        return self

    def _grow(self, binned, edges, slope, curve):
        """One tree: for each inner node a feature and a limit, for each leaf a value."""
        inner = 2**self.depth - 1
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(slope), dtype=np.int64)
        for v in range(inner):
            rows = np.flatnonzero(node == v)
            best = 1e-6
            choice = None
            if len(rows) >= 2 * self.smallest:
                g, h = slope[rows], curve[rows]
                whole = g.sum() ** 2 / (h.sum() + 1)
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = binned[rows, j]
                    n = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                    gl = np.cumsum(np.bincount(b, g, minlength=len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h, minlength=len(e) + 1))[:-1]
                    gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - whole
                    gain[(n < self.smallest) | (len(rows) - n < self.smallest)] = 0
                    if gain.max() > best:
                        best, choice = gain.max(), (j, int(gain.argmax()))
            if choice:
                feature[v], limit[v] = choice[0], edges[choice[0]][choice[1]]
                right = binned[rows, choice[0]] > choice[1]
            else:
                right = np.zeros(len(rows), dtype=bool)
            node[rows] = 2 * v + 1 + right
        leaf = node - inner
        g = np.bincount(leaf, slope, minlength=inner + 1)
        h = np.bincount(leaf, curve, minlength=inner + 1)
        return (feature, limit, self.rate * g / (h + 1)), leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            out += value[node - len(feature)]
        return out
