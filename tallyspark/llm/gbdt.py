"""Histogram gradient-boosted trees for two classes, in numpy.

Features are cut into at most 64 bins at quantiles. A tree grows level by level, each split the best
over histograms of gradients and hessians of the log loss. Trees are flattened into arrays
(feature, threshold, left, right, value), one entry per node over all trees, so a whole batch
walks a tree with a few numpy steps per level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    feature: np.ndarray       # -1 at a leaf
    threshold: np.ndarray     # goes left if x <= threshold
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.bias)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[node], self.left[node], self.right[node])
                node = np.where(f < 0, node, down)
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500))) if len(x) else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15,
        bins: int = 64, leaf: int = 8, ridge: float = 1.0) -> Forest:
    """``x``: rows by features, ``y``: 0 or 1. Without both classes the score is a constant."""
    n, m = x.shape
    share = np.clip(y.mean() if n else 0.5, 0.001, 0.999)
    cols: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def node(value: float) -> int:
        for k, v in zip(cols, (-1, 0.0, 0, 0, value)):
            cols[k].append(v)
        return len(cols["value"]) - 1

    bias = float(np.log(share / (1 - share)))
    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(m)]
        code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], 1)   # <= cut k: bin k
        flat = code + np.arange(m) * bins
        margin = np.full(n, bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, np.maximum(p * (1 - p), 1e-6)
            roots.append(root := node(0.0))
            level = {root: np.arange(n)}
            for d in range(depth + 1):
                below = {}
                for at, rows in level.items():
                    gs, hs = g[rows].sum(), h[rows].sum()
                    best = (1e-6, -1, -1)
                    if d < depth and len(rows) >= 2 * leaf:
                        idx = flat[rows].ravel()
                        hist = [np.bincount(idx, np.repeat(w[rows], m), m * bins).reshape(m, bins).cumsum(1)
                                for w in (g, h, np.ones(n))]
                        gl, hl, nl = hist
                        gain = (gl ** 2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs ** 2 / (hs + ridge))
                        gain[(nl < leaf) | (len(rows) - nl < leaf)] = 0
                        j, k = np.unravel_index(gain.argmax(), gain.shape)
                        if gain[j, k] > best[0] and k < len(cuts[j]):
                            best = (gain[j, k], j, k)
                    if best[1] < 0:
                        v = -rate * gs / (hs + ridge)
                        cols["value"][at] = v
                        margin[rows] += v
                        continue
                    _, j, k = best
                    goes = code[rows, j] <= k
                    a, b = node(0.0), node(0.0)
                    cols["feature"][at], cols["threshold"][at] = int(j), float(cuts[j][k])
                    cols["left"][at], cols["right"][at] = a, b
                    below |= {a: rows[goes], b: rows[~goes]}
                level = below
    arrays = {k: np.array(v, np.float64 if k in ("threshold", "value") else np.int64) for k, v in cols.items()}
    return Forest(**arrays, roots=np.array(roots, np.int64), depth=depth, bias=bias)
