"""Gradient-boosted trees with logistic loss and isotonic calibration, in numpy, for a few thousand rows."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Depth-limited trees over quantile bins. `fit` takes what was sampled; `margin` is vectorised over rows."""

    def __init__(self, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0, least_rows: int = 5):
        self.n, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least_rows
        self.base = 0.0
        self.cuts: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = []
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            middles = (values[1:] + values[:-1]) / 2
            if len(middles) >= self.bins:
                # half the cuts by rows, half among the largest values, where rare signals lie
                by_rows = np.quantile(x[:, f], np.linspace(0, 1, self.bins // 2 + 1)[1:-1])
                by_value = np.quantile(values, np.linspace(0, 1, self.bins // 2 + 2)[1:-1])
                middles = np.unique(np.concatenate((by_rows, by_value)))
            self.cuts.append(middles)
        q = self._binned(x)
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(p / (1 - p)))
        margin = np.full(len(y), self.base)
        width = self.bins + 1
        for _ in range(self.n):
            prob = 1 / (1 + np.exp(-margin))
            g, h = prob - y, prob * (1 - prob)
            nodes = 2 ** (self.depth + 1) - 1
            feature, cut, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
            node = np.zeros(len(y), dtype=np.int64)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                local = node - first
                live = (local >= 0) & (local < count)
                best = np.full(count, 1e-6)
                for f, cuts in enumerate(self.cuts):
                    if not len(cuts):
                        continue
                    key = local[live] * width + q[live, f]
                    gs = np.bincount(key, g[live], count * width).reshape(count, width).cumsum(axis=1)
                    hs = np.bincount(key, h[live], count * width).reshape(count, width).cumsum(axis=1)
                    ns = np.bincount(key, minlength=count * width).reshape(count, width).cumsum(axis=1)
                    gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                    gain = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
                    gain[(ns < self.least) | (nt - ns < self.least)] = 0
                    gain = gain[:, : len(cuts)]
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(count), at]
                    better = top > best
                    best = np.where(better, top, best)
                    feature[first : first + count][better] = f
                    cut[first : first + count][better] = cuts[at[better]]
                split = live & (feature[node] >= 0)
                right = x[split, feature[node[split]]] > cut[node[split]]
                node[split] = 2 * node[split] + 1 + right
            gsum, hsum = np.bincount(node, g, nodes), np.bincount(node, h, nodes)
            value = -self.rate * gsum / (hsum + self.ridge)
            margin += value[node]
            self.trees.append((feature, cut, value))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[node]
                split = f >= 0
                right = x[rows, np.maximum(f, 0)] > cut[node]
                node = np.where(split, 2 * node + 1 + right, node)
            out += value[node]
        return out


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (margins, probabilities) to interpolate between; probabilities shrink a little
    towards 1/2 so none is certain."""
    levels, at = np.unique(margin, return_inverse=True)  # rows of one margin are one point from the start
    hits, rows = np.bincount(at, y), np.bincount(at).astype(float)
    blocks: list[list[float]] = []
    for m, h, n in zip(levels.tolist(), hits.tolist(), rows.tolist()):
        blocks.append([m, h, n, m])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1][1] += last[1]
            blocks[-1][2] += last[2]
            blocks[-1][3] = last[3]
    xs, ys = [], []
    for low, hits, n, high in blocks:
        p = (hits + 0.25) / (n + 0.5)
        xs += [low, high] if high > low else [low]
        ys += [p, p] if high > low else [p]
    return np.array(xs), np.array(ys)
