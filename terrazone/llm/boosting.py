"""Gradient boosted trees for small bounded samples: logistic loss, binned features, trees of a fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete binary trees: inner nodes in level order, leaves from left to right."""

    start: float
    feature: np.ndarray
    above: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, above, leaf in zip(self.feature, self.above, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > above[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, smoothing: float = 1.0) -> Boosted:
    """Fit to labels 0 and 1. Splits lie between quantiles of a feature; constant features are never split."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    mean = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    start, inner = float(np.log(mean / (1 - mean))), 2**depth - 1
    features, above, leaves = (np.zeros((trees, k), t) for k, t in ((inner, np.int64), (inner, float), (inner + 1, float)))
    total, cell = np.full(n, start), np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * bins) + cell + binned).ravel()
            g, h = (np.bincount(at, np.repeat(v, width), count * width * bins).reshape(count, width, bins) for v in (slope, curve))
            gl, hl = g.cumsum(2), h.cumsum(2)
            gr, hr = gl[:, :, -1:] - gl, hl[:, :, -1:] - hl
            gain = gl**2 / (hl + smoothing) + gr**2 / (hr + smoothing)
            gain[(hl <= 1e-9) | (hr <= 1e-9)] = -1
            best = gain.reshape(count, -1).argmax(1)
            f, b = best // bins, best % bins
            features[t, first:first + count] = f
            above[t, first:first + count] = [edges[i][j] if j < len(edges[i]) else np.inf for i, j in zip(f, b)]
            node = 2 * node + 1 + (x[np.arange(n), features[t, node]] > above[t, node])
        g, h = (np.bincount(node - inner, v, inner + 1) for v in (slope, curve))
        leaves[t] = rate * g / (h + smoothing)
        total += leaves[t, node - inner]
    return Boosted(start, features, above, leaves)
