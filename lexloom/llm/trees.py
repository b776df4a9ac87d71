"""Histogram gradient boosting for two classes: numpy training, flattened vectorised scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Complete binary trees in arrays: row t holds tree t, child of node i at 2i+1 and 2i+2.

    `feature` and `cut` are [trees, 2^depth - 1], `leaf` is [trees, 2^depth]; a row goes
    right where its feature exceeds the cut. Closed nodes have an infinite cut.
    """

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def cut_points(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature at most bins - 1 cuts, midway between neighbouring distinct values."""
    cuts = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins)))
        cuts.append((values[1:] + values[:-1]) / 2)
    return cuts


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2,
    l2: float = 1.0, least: float = 2.0,
) -> Forest:
    """Newton boosting of the log loss on binned features, grown level by level from histograms.

    `least` is the smallest sum of second derivatives in a child. Without rows, or with
    one class only, the forest has no trees and scores the smoothed share of ones.
    """
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(share / (1 - share)))
    inner, outer = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, outer)), base)
    cuts = cut_points(x, bins)
    width = x.shape[1]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]).astype(np.int64)
    margin = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            slot = (node - first) * bins
            best = np.zeros(count)
            choice = np.zeros((count, 2), np.int64)
            for f in range(width):
                if not len(cuts[f]):
                    continue
                at = slot + binned[f]
                gs = np.bincount(at, g, count * bins).reshape(count, bins)
                hs = np.bincount(at, h, count * bins).reshape(count, bins)
                gl, hl = gs.cumsum(1), hs.cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(hl < least) | (ht - hl < least)] = 0
                gain = gain[:, : len(cuts[f])]
                top = gain.argmax(1)
                value = gain[np.arange(count), top]
                better = value > best + 1e-9
                best[better] = value[better]
                choice[better] = np.stack([np.full(count, f), top], 1)[better]
            for k in np.nonzero(best > 0)[0]:
                f, b = choice[k]
                feature[first + k], cut[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        slot = node - inner
        leaf = rate * np.bincount(slot, g, outer) / (np.bincount(slot, h, outer) + l2)
        margin += leaf[slot]
        features.append(feature)
        thresholds.append(cut)
        leaves.append(leaf)
    return Forest(np.array(features), np.array(thresholds), np.array(leaves), base)
