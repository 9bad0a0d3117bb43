"""Gradient-boosted trees on binned features, trained and evaluated with numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth, flattened: node ``k`` has the children ``2k+1`` and ``2k+2``.

    A row goes right where ``feature > threshold``. Nodes that were not worth splitting
    send every row left.
    """

    feature: np.ndarray  # (trees, inner nodes) int
    threshold: np.ndarray  # (trees, inner nodes) float
    leaf: np.ndarray  # (trees, leaves) float
    bias: float

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Of label 1, for each row of features; all rows go down a tree level by level together."""
        total = np.full(len(rows), self.bias)
        inner = self.feature.shape[1]
        at = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (rows[at, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` distinct thresholds that split the values evenly."""
    distinct = np.unique(values)
    if len(distinct) <= bins:
        return (distinct[1:] + distinct[:-1]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    penalty: float = 1.0, least_rows: float = 5.0,
) -> Trees:
    """Trees for the logistic loss. Without rows, or with one label only, the base rate alone decides."""
    inner, leaves = 2**depth - 1, 2**depth
    rate_of_ones = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    n_features = rows.shape[1]
    if len(rows) == 0 or labels.min() == labels.max():
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), bias)
    cuts = [cut_points(rows[:, f], bins) for f in range(n_features)]
    binned = np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    total = np.full(len(rows), bias)
    out = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = labels - p, p * (1 - p)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gains = np.full((width, n_features, bins), -np.inf)
            for f in range(n_features):
                cell = (node - first) * bins + binned[:, f]
                g, h, n = (
                    np.bincount(cell, w, width * bins).reshape(width, bins).cumsum(axis=1)
                    for w in (slope, curve, np.ones(len(rows)))
                )
                g_all, h_all, n_all = g[:, -1:], h[:, -1:], n[:, -1:]
                gain = g**2 / (h + penalty) + (g_all - g) ** 2 / (h_all - h + penalty) - g_all**2 / (h_all + penalty)
                gains[:, f] = np.where((n >= least_rows) & (n_all - n >= least_rows), gain, -np.inf)
                gains[:, f, len(cuts[f]) :] = -np.inf
            best = gains.reshape(width, -1).argmax(axis=1)
            worth = gains.reshape(width, -1)[np.arange(width), best] > 1e-6
            f_best, cut = best // bins, best % bins
            for k in np.flatnonzero(worth):
                feature[first + k], threshold[first + k] = f_best[k], cuts[f_best[k]][cut[k]]
            # same comparison as on unbinned values: bin > cut exactly where value > threshold
            own = node - first
            right = worth[own] & (binned[np.arange(len(rows)), f_best[own]] > cut[own])
            node = 2 * node + 1 + right
        leaf_of = node - inner
        leaf = rate * np.bincount(leaf_of, slope, leaves) / (np.bincount(leaf_of, curve, leaves) + penalty)
        total += leaf[leaf_of]
        for store, new in zip(out, (feature, threshold, leaf), strict=True):
            store.append(new)
    return Trees(*(np.array(x) for x in out), bias)
