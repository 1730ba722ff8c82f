"""Gradient-boosted regression trees for two classes, in numpy: binned features, depth-wise splits, log loss."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """Each tree is a full binary tree of `depth` levels, held as arrays of features, limits and leaf values."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, penalty: float = 2.0):
        self.rounds, self.depth, self.rate, self.penalty = rounds, depth, rate, penalty
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        limits = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        binned = np.stack([np.searchsorted(cut, column) for cut, column in zip(limits, x.T, strict=True)], axis=1)
        logit = np.zeros(len(y))
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-logit))
            tree = self.grown(binned, limits, p - y, p * (1 - p))
            self.trees.append(tree)
            logit += self.value_of(tree, x)
        return self

    def grown(self, binned: np.ndarray, limits: list[np.ndarray], gradient: np.ndarray, curvature: np.ndarray):
        inner = 2**self.depth - 1
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(gradient), np.int64)
        for level in range(self.depth):
            first, width = 2**level - 1, 2**level
            own = node - first
            gain, choice = np.zeros(width), np.full((width, 2), -1)
            sums = [np.bincount(own, weights, width) for weights in (gradient, curvature)]
            for f, cuts in enumerate(limits):
                if not len(cuts):
                    continue
                cell = own * (len(cuts) + 1) + binned[:, f]
                size = width * (len(cuts) + 1)
                left = [np.bincount(cell, w, size).reshape(width, -1).cumsum(axis=1)[:, :-1] for w in (gradient, curvature)]
                right = [s[:, None] - part for s, part in zip(sums, left, strict=True)]
                score = sum(g * g / (h + self.penalty) for g, h in (left, right))
                score -= (sums[0] ** 2 / (sums[1] + self.penalty))[:, None]
                best = score.argmax(axis=1)
                better = score[np.arange(width), best] > gain + 1e-9
                gain = np.where(better, score[np.arange(width), best], gain)
                choice[better] = np.stack([np.full(width, f), best], axis=1)[better]
            for k, (f, at) in enumerate(choice):
                if f >= 0:
                    feature[first + k], limit[first + k] = f, limits[f][at]
            bins = np.array([at if f >= 0 else BINS + 1 for f, at in choice])
            went_right = binned[np.arange(len(node)), feature[node]] > bins[own]
            node = 2 * node + 1 + went_right
        leaf = node - inner
        total = [np.bincount(leaf, w, 2**self.depth) for w in (gradient, curvature)]
        return feature, limit, -self.rate * total[0] / (total[1] + self.penalty)

    def value_of(self, tree: tuple, x: np.ndarray) -> np.ndarray:
        feature, limit, leaves = tree
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
        return leaves[node - len(feature)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return sum((self.value_of(tree, x) for tree in self.trees), np.zeros(len(x)))
