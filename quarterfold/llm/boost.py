"""Gradient-boosted trees for binary labels over binned features, as flat arrays.

Training looks at histograms of gradients by bin, so it needs one pass over the binned rows a level; rows
carry weights, so counted rows train as the rows they stand for. All trees lie in one set of arrays, and
scoring walks them with numpy, all rows at once, or as a SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 64


@dataclass
class Trees:
    """Node i sends a row to ``left[i]`` if bin[feature[i]] <= cut[i], else to ``right[i]``; leaves point to themselves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int

    def margin(self, binned: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        total = np.full(len(binned), self.start)
        every = np.arange(len(binned))
        for root in self.roots:
            at = np.full(len(binned), root)
            for _ in range(self.depth):
                at = np.where(binned[every, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            total += self.value[at]
        return total

    def sql(self, features: list[Column]) -> Column:
        """Log-odds over integer columns that hold the bins."""
        def node(i: int) -> Column:
            if self.left[i] == i:
                return F.lit(float(self.value[i]))
            return F.when(features[self.feature[i]] <= int(self.cut[i]), node(self.left[i])).otherwise(node(self.right[i]))

        total = F.lit(float(self.start))
        for root in self.roots:
            total = total + node(int(root))
        return total


def edges(values: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cut points of each feature, at its quantiles."""
    q = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(v, q)) for v in values.T]


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, values.T, strict=True)], axis=1).astype(np.uint8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 60, depth: int = 4,
        rate: float = 0.15, smooth: float = 1.0, least: float = 5.0, bins: int = BINS) -> Trees:
    """x: bins below ``bins``. ``least``: weight on either side of a split; ``smooth``: added to the second derivatives."""
    w = np.ones(len(y)) if weight is None else weight.astype(float)
    share = float(np.clip((w @ y + 1) / (w.sum() + 2), 1e-4, 1 - 1e-4))
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(y), start)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def leaf(g: float, h: float) -> int:
        i = len(feature)
        for array, v in ((feature, 0), (cut, 0), (left, i), (right, i), (value, -rate * g / (h + smooth))):
            array.append(v)
        return i

    for _ in range(trees if len(y) else 0):
        p = sigmoid(margin)
        g, h = w * (p - y), w * p * (1 - p)
        root = leaf(g.sum(), h.sum())
        roots.append(root)
        at = np.full(len(y), root)
        level = [root]
        for _ in range(depth):
            slot = np.full(len(feature), -1)
            slot[level] = np.arange(len(level))
            on = slot[at] >= 0
            cell, n = slot[at[on]] * bins, len(level) * bins
            best = np.zeros(len(level)), np.full(len(level), -1), np.zeros(len(level), int)
            for f in range(x.shape[1]):
                where = cell + x[on, f]
                gs, hs, ws = (np.bincount(where, v[on], n).reshape(-1, bins).cumsum(1) for v in (g, h, w))
                ga, ha, wa = (s[:, -1:] for s in (gs, hs, ws))
                gain = gs**2 / (hs + smooth) + (ga - gs) ** 2 / (ha - hs + smooth) - ga**2 / (ha + smooth)
                gain[(ws < least) | (wa - ws < least)] = 0
                b = gain.argmax(1)
                top = gain[np.arange(len(level)), b]
                better = top > best[0] + 1e-9
                best[0][better], best[1][better], best[2][better] = top[better], f, b[better]
            following = []
            for i, node in enumerate(level):
                if best[1][i] < 0:
                    continue
                f, b = int(best[1][i]), int(best[2][i])
                mine = at == node
                low = mine & (x[:, f] <= b)
                high = mine & ~low
                feature[node], cut[node] = f, b
                left[node], right[node] = leaf(g[low].sum(), h[low].sum()), leaf(g[high].sum(), h[high].sum())
                at[low], at[high] = left[node], right[node]
                following += [left[node], right[node]]
            level = following
            if not level:
                break
        margin += np.asarray(value)[at]
    return Trees(*(np.asarray(a) for a in (feature, cut, left, right)), np.asarray(value, float), np.asarray(roots, int), start, depth)
