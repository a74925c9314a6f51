"""Gradient-boosted trees for a weighted binary label, and isotonic calibration, in numpy."""

from __future__ import annotations

import numpy as np


class Trees:
    """Complete trees of one depth on binned features, fitted to the gradient of the logistic loss."""

    def __init__(self, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, ridge: float = 2.0):
        self.n, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.start = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        """Null-free features; labels 0 and 1. With one label only, the trees are empty and the start decides."""
        mean = np.clip((weight * y).sum() / max(weight.sum(), 1e-12), 1e-4, 1 - 1e-4)
        self.start = float(np.log(mean / (1 - mean)))
        self.trees = []
        if len(y) < 10 or len(set(y.tolist())) < 2:
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(cuts, x.T, strict=True)], axis=1)
        raw = np.full(len(y), self.start)
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(len(y), np.int64)
            features, limits = [], []
            for level in range(self.depth):
                size = (1 << level) * self.bins
                best = np.full(1 << level, 1e-9)
                feature, limit = np.zeros(1 << level, np.int64), np.full(1 << level, np.inf)
                for f in range(x.shape[1]):
                    if not len(cuts[f]):
                        continue
                    at = node * self.bins + binned[:, f]
                    g = np.bincount(at, grad, size).reshape(-1, self.bins).cumsum(axis=1)
                    h = np.bincount(at, hess, size).reshape(-1, self.bins).cumsum(axis=1)
                    gt, ht = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + self.ridge) + (gt - g) ** 2 / (ht - h + self.ridge) - gt**2 / (ht + self.ridge)
                    gain = gain[:, : len(cuts[f])]
                    k = gain.argmax(axis=1)
                    top = gain[np.arange(len(k)), k]
                    better = top > best
                    best[better], feature[better], limit[better] = top[better], f, cuts[f][k[better]]
                features.append(feature)
                limits.append(limit)
                node = 2 * node + (x[np.arange(len(y)), feature[node]] > limit[node])
            g, h = np.bincount(node, grad, 1 << self.depth), np.bincount(node, hess, 1 << self.depth)
            leaf = self.rate * g / (h + self.ridge)
            self.trees.append((np.concatenate(features), np.concatenate(limits), leaf))
            raw += leaf[node]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for features, limits, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, features[at]] > limits[at])
            out += leaf[node]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps (value, rate) by pooling adjacent violators; equal values are pooled first."""
    values, group = np.unique(raw, return_inverse=True)
    w, s = np.bincount(group, weight), np.bincount(group, weight * y)
    pools: list[list[float]] = []
    for v, a, b in zip(values, w, s, strict=True):
        pools.append([v, a, b])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            _, a, b = pools.pop()
            pools[-1] = [pools[-1][0], pools[-1][1] + a, pools[-1][2] + b]
    return np.array([p[0] for p in pools]), np.array([p[2] / p[1] for p in pools])


def calibrated(raw: np.ndarray, steps: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The step's rate, with two hundredths of the raw probability so that the order inside a step stays."""
    at, rate = steps
    base = rate[np.clip(np.searchsorted(at, raw, side="right") - 1, 0, len(rate) - 1)] if len(at) else 1 / (1 + np.exp(-raw))
    return np.clip(0.98 * base + 0.02 / (1 + np.exp(-raw)), 0.0, 1.0)
