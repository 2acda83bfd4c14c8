"""Histogram boosting for small dense feature tables, and isotonic calibration (numpy)."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature the inner edges of at most ``bins`` quantile bins."""
    q = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(c, q)) if len(c) else np.zeros(0) for c in x.T]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1).astype(np.int32)


def split_gain(g: np.ndarray, h: np.ndarray, ridge: float):
    """Best cut of ordered bins: (gain, first bin of the right side); gain 0 for none."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    if not len(gl):
        return 0.0, 0
    gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
    gain[(hl < 1e-6) | (ht - hl < 1e-6)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


class BoostedTrees:
    """Gradient-boosted trees for log loss; trees are arrays in heap order."""

    def __init__(self, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, ridge: float = 2.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.model: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> BoostedTrees:
        w = w / w.mean()
        self.edges = bin_edges(x, self.bins)
        b = to_bins(x, self.edges)
        base = np.clip((w * y).sum() / w.sum(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(base / (1 - base)))
        raw = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = sigmoid(raw)
            tree = self._tree(b, w * (y - p), w * p * (1 - p))
            self.model.append(tree)
            raw += self._leaf(tree, b)
        return self

    def _tree(self, b, g, h):
        nodes = (1 << self.depth) - 1
        feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
        value = np.zeros(nodes + (1 << self.depth))
        where = np.zeros(len(b), np.int64)
        width = self.bins + 1
        for node in range(nodes):
            rows = np.flatnonzero(where == node)
            if not len(rows):
                continue
            best = (1e-3, -1, 0)
            for f in range(b.shape[1]):
                gain, at = split_gain(np.bincount(b[rows, f], g[rows], width), np.bincount(b[rows, f], h[rows], width), self.ridge)
                if gain > best[0]:
                    best = (gain, f, at)
            _, feature[node], cut[node] = best
            right = b[rows, best[1]] >= best[2] if best[1] >= 0 else np.zeros(len(rows), bool)
            where[rows] = 2 * node + 1 + right
        for leaf in range(nodes, len(value)):
            rows = where == leaf
            value[leaf] = self.rate * g[rows].sum() / (h[rows].sum() + self.ridge)
        return feature, cut, value

    def _leaf(self, tree, b):
        feature, cut, value = tree
        at = np.zeros(len(b), np.int64)
        rows = np.arange(len(b))
        for _ in range(self.depth):
            f = feature[at]
            at = 2 * at + 1 + ((f >= 0) & (b[rows, np.maximum(f, 0)] >= cut[at]))
        return value[at]

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = to_bins(x, self.edges)
        out = np.full(len(x), self.base)
        for tree in self.model:
            out += self._leaf(tree, b)
        return out


class Isotonic:
    """Isotonic regression by pooling adjacent violators, read by linear interpolation."""

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Isotonic:
        order = np.argsort(x, kind="stable")
        blocks: list[list[float]] = []  # mean, weight, weighted sum of x
        for xi, yi, wi in zip(x[order], y[order], w[order]):
            blocks.append([yi, wi, xi * wi])
            while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
                m, v, s = blocks.pop()
                p = blocks[-1]
                p[0] = (p[0] * p[1] + m * v) / (p[1] + v)
                p[1] += v
                p[2] += s
        self.at = np.array([s / v for _, v, s in blocks])
        self.value = np.array([m for m, _, _ in blocks])
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.at, self.value)
