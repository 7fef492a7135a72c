"""Gradient-boosted regression trees for two classes, on features of few values."""

from __future__ import annotations

import numpy as np


class Trees:
    """Boosted trees as flat arrays: each level splits on one feature and threshold per node."""

    def __init__(self, depth: int, base: float, features: np.ndarray, cuts: np.ndarray, leaves: np.ndarray) -> None:
        self.depth, self.base, self.features, self.cuts, self.leaves = depth, base, features, cuts, leaves

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds of every row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, leaf in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += leaf[at - (2**self.depth - 1)]
        return out


def fitted(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.3, smooth: float = 1.0, bins: int = 32) -> Trees:
    """Trees boosted on the logistic loss; splits are searched on at most ``bins`` quantiles of a feature.

    Equal gains go to the first feature and lower cut, so the result depends on
    the rows only.  One class alone, or no rows, gives a constant.
    """
    n, m = x.shape
    share = float(np.clip(y.mean() if n else 0.0, 1e-4, 1 - 1e-4))
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[:-1], method="lower")) if n else np.zeros(1) for f in range(m)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(m)], axis=1) if n else np.zeros((0, m), dtype=np.int64)
    width = max(len(c) for c in cuts) + 1
    inner = 2**depth - 1
    features, limits, leaves = [], [], []
    score = np.full(n, base)
    for _ in range(rounds if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        f_of, c_of = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = at - first
            best, where = np.full(count, 1e-9), [(0, -1)] * count
            for f in range(m):
                cell = local * width + binned[:, f]
                gs = np.bincount(cell, g, count * width).reshape(count, width).cumsum(1)
                hs = np.bincount(cell, h, count * width).reshape(count, width).cumsum(1)
                total_g, total_h = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + smooth) + (total_g - gs) ** 2 / (total_h - hs + smooth) - total_g**2 / (total_h + smooth)
                gain = gain[:, : len(cuts[f])]
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                for node in np.flatnonzero(top > best + 1e-9):
                    best[node], where[node] = top[node], (f, int(k[node]))
            for node, (f, k) in enumerate(where):
                if k >= 0:
                    f_of[first + node], c_of[first + node] = f, cuts[f][k]
            at = 2 * at + 1 + (x[np.arange(n), f_of[at]] > c_of[at])
        leaf = at - inner
        sums, weights = np.bincount(leaf, g, 2**depth), np.bincount(leaf, h, 2**depth)
        values = rate * sums / (weights + smooth)
        score = score + values[leaf]
        features.append(f_of)
        limits.append(c_of)
        leaves.append(values)
    shape = (0, inner)
    return Trees(depth, base, np.array(features) if features else np.zeros(shape, dtype=np.int64), np.array(limits) if limits else np.zeros(shape), np.array(leaves) if leaves else np.zeros((0, 2**depth)))
