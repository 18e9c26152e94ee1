"""Gradient-boosted trees for yes/no labels: fitted on a bounded sample in NumPy, kept as flat node arrays.

Chosen features can be constrained: +1 means that the score never falls, -1
that it never rises, as the feature grows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees in a row; a leaf has feature -1 and its own number as both children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of yes per row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, np.maximum(self.feature[node], 0)] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def constant(probability: float) -> Trees:
    none = np.zeros(0, np.int64)
    odds = float(np.log(probability / (1 - probability)))
    return Trees(none, np.zeros(0), none, none, np.zeros(0), none, odds, 0)


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15,
        bins: int = 64, ridge: float = 1.0, least_weight: float = 2.0) -> Trees:
    """Log-loss boosting by histograms. ``x`` is finite; rows should come in a fixed order for equal reruns."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return constant(min(max(share, 1e-3), 1 - 1e-3))
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(v: float) -> int:
        k = len(feature)
        feature.append(-1), threshold.append(0.0), left.append(k), right.append(k), value.append(v)
        return k

    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        root = add(0.0)
        roots.append(root)
        at = np.full(n, root)
        level = {root: (-np.inf, np.inf)}
        for _ in range(depth):
            names = {k: i for i, k in enumerate(level)}
            slot = np.full(len(feature), -1)
            slot[list(names)] = range(len(names))
            rows = np.flatnonzero(slot[at] >= 0)
            where = slot[at[rows]]
            best = {k: (1e-6, None) for k in level}
            for j in range(m):
                width = len(edges[j]) + 1
                if width == 1:
                    continue
                cell = where * width + binned[rows, j]
                gs = np.cumsum(np.bincount(cell, g[rows], len(names) * width).reshape(-1, width), axis=1)
                hs = np.cumsum(np.bincount(cell, h[rows], len(names) * width).reshape(-1, width), axis=1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gr, hr = gt - gl, ht - hl
                low = np.array([level[k][0] for k in level])[:, None]
                high = np.array([level[k][1] for k in level])[:, None]
                vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                v = np.clip(-gt / (ht + ridge), low, high)
                loss = lambda a, b, w: a * w + 0.5 * (b + ridge) * w * w
                gain = loss(gt, ht, v) - loss(gl, hl, vl) - loss(gr, hr, vr)
                bad = (hl < least_weight) | (hr < least_weight) | (monotone[j] * (vr - vl) < 0)
                gain = np.where(bad, -np.inf, gain)
                top = np.argmax(gain, axis=1)
                for k, i in names.items():
                    if gain[i, top[i]] > best[k][0]:
                        best[k] = (gain[i, top[i]], (j, int(top[i]), vl[i, top[i]], vr[i, top[i]]))
            following = {}
            for k, (_, found) in best.items():
                if found is None:
                    continue
                j, cut, a, b = found
                low, high = level[k]
                middle = (a + b) / 2
                lk, rk = add(float(a)), add(float(b))
                feature[k], threshold[k], left[k], right[k] = j, float(edges[j][cut]), lk, rk
                following[lk] = (max(low, middle) if monotone[j] < 0 else low, min(high, middle) if monotone[j] > 0 else high)
                following[rk] = (max(low, middle) if monotone[j] > 0 else low, min(high, middle) if monotone[j] < 0 else high)
                here = rows[at[rows] == k]
                at[here] = np.where(binned[here, j] <= cut, lk, rk)
            if not following:
                break
            level = following
        for k in range(root, len(value)):
            value[k] *= rate
        margin += np.array(value)[at]
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value),
                 np.array(roots), base, depth)
