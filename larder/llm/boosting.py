"""Gradient-boosted trees and isotonic calibration on dense features (numpy).

Fitted on the driver from a bounded sample, applied inside tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees: node k has children 2k+1 and 2k+2; a split sends x <= cut left."""

    base: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.features.shape[1] if len(self.features) else 0
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - inner]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15,
              bins: int = 32, l2: float = 1.0, least: float = 1.0) -> Trees:
    """Logistic loss, second-order splits over quantile bins, level by level."""
    n, f = x.shape
    rate_1 = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(rate_1 / (1 - rate_1)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(1) for j in range(f)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1) if f else np.zeros((n, 0), int)
    margin, inner = np.full(n, base), 2**depth - 1
    features, cuts, leaves = [], [], []
    for _ in range(trees if n and 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, cut, at = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            node, best = at - first, np.zeros(width)
            for j, e in enumerate(edges):
                k = len(e) + 1
                g = np.bincount(node * k + binned[:, j], grad, width * k).reshape(width, k).cumsum(axis=1)
                h = np.bincount(node * k + binned[:, j], hess, width * k).reshape(width, k).cumsum(axis=1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain = np.where((hl >= least) & (ht - hl >= least), gain, 0)
                if not gain.shape[1]:
                    continue
                pick = gain.argmax(axis=1)
                value = gain[np.arange(width), pick]
                better = value > best
                best = np.where(better, value, best)
                for w in np.flatnonzero(better):
                    feature[first + w], cut[first + w] = j, e[pick[w]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        leaf_at = at - inner
        leaf = -rate * np.bincount(leaf_at, grad, inner + 1) / (np.bincount(leaf_at, hess, inner + 1) + l2)
        margin += leaf[leaf_at]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Trees(base, np.array(features).reshape(-1, inner), np.array(cuts).reshape(-1, inner), np.array(leaves).reshape(-1, inner + 1))


@dataclass
class Isotonic:
    """A rising step-and-line function from margins to probabilities."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, margins: np.ndarray) -> np.ndarray:
        return np.interp(margins, self.x, self.y)


def fit_isotonic(margins: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; each pool counts one extra row at the overall rate, so no pool says exactly 0 or 1."""
    if not len(y):
        return Isotonic(np.zeros(1), np.full(1, 0.0))
    order, mean = np.argsort(margins, kind="stable"), float(y.mean())
    pools: list[list[float]] = []  # label sum, rows, margin sum
    for m, label in zip(margins[order], y[order], strict=True):
        pools.append([float(label), 1.0, float(m)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    x = np.array([p[2] / p[1] for p in pools])
    return Isotonic(x, np.maximum.accumulate([(p[0] + mean) / (p[1] + 1) for p in pools]))
