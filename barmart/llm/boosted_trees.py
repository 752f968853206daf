"""Gradient-boosted trees for two classes: histograms of binned features, logistic loss, complete trees of one depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Inner nodes in level order, then leaves; a row goes right where its feature is above the limit."""

    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray
    start: float

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of class 1."""
        out = np.full(len(rows), self.start)
        at = np.arange(len(rows))
        for features, limits, leaves in zip(self.features, self.limits, self.leaves):
            node = np.zeros(len(rows), np.int64)
            while len(node) and node[0] < len(features):
                node = 2 * node + 1 + (rows[at, features[node]] > limits[node])
            out += leaves[node - len(features)]
        return out


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, least: float = 1.0) -> Trees:
    """Trees from (rows, features) and labels 0 or 1; `least` is added to every sum of second derivatives."""
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    codes = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)]).astype(np.int64)
    single = {f: k for k, f in enumerate(f for f in range(width) if len(edges[f]) == 1)}
    below_limit = (codes[list(single)] == 0).astype(np.float32)
    rate_1 = np.clip(labels.mean() if n else 0.5, 0.01, 0.99)
    start = float(np.log(rate_1 / (1 - rate_1)))
    margin = np.full(n, start)
    out_f, out_l, out_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - labels, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        features, limits = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for level in range(depth):
            size, first = 2**level, 2**level - 1
            best = np.full(size, 1e-9)
            local = (node - first) * bins
            # Features with one limit share one product of matrices; the others have a histogram each.
            by_node = np.zeros((n, 2 * size), np.float32)
            by_node[np.arange(n), node - first] = slope
            by_node[np.arange(n), size + node - first] = bend
            lower, total = below_limit @ by_node, by_node.sum(0)
            for f in range(width):
                if not len(edges[f]):
                    continue
                if f in single:
                    part = lower[single[f]]
                    g, h = (np.stack([part[at], total[at]], 1) for at in (slice(size), slice(size, None)))
                else:
                    g, h = (np.bincount(local + codes[f], w, size * bins).reshape(size, bins).cumsum(1) for w in (slope, bend))
                left, right = g**2 / (h + least), (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + least)
                gain = (left + right - left[:, -1:])[:, : len(edges[f])]
                cut = gain.argmax(1)
                value = gain[np.arange(size), cut]
                better = value > best
                best = np.where(better, value, best)
                features[first : first + size][better] = f
                limits[first : first + size][better] = edges[f][cut[better]]
            node = 2 * node + 1 + (rows[np.arange(n), features[node]] > limits[node])
        leaf = node - (2**depth - 1)
        g, h = (np.bincount(leaf, w, 2**depth) for w in (slope, bend))
        values = -rate * g / (h + least)
        margin += values[leaf]
        out_f.append(features), out_l.append(limits), out_v.append(values)
    return Trees(np.array(out_f), np.array(out_l), np.array(out_v), start)
