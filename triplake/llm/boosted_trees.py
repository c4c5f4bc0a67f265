"""Gradient-boosted trees for a few classes: histograms of binned features, second-order leaf values, softmax loss."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """A fitted ensemble: ``rounds`` trees a class, all of one depth; arrays only, so it travels with a task."""

    def __init__(self, classes: int, rounds: int = 30, depth: int = 5, rate: float = 0.25, penalty: float = 1.0,
                 least_weight: float = 2.0) -> None:
        self.classes, self.rounds, self.depth = classes, rounds, depth
        self.rate, self.penalty, self.least_weight = rate, penalty, least_weight

    def _binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for f, edges in enumerate(self.edges):
            out[:, f] = np.searchsorted(edges, x[:, f], side="left")
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "BoostedTrees":
        """``y`` holds class numbers. Rows and features are taken in the given order: the same input gives the same trees."""
        n, features = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(features)]
        binned = self._binned(x)
        flat = binned.astype(np.int64) + np.arange(features) * BINS
        inner = (1 << self.depth) - 1
        self.feature = np.zeros((self.rounds, self.classes, inner), np.int32)
        self.threshold = np.full((self.rounds, self.classes, inner), BINS, np.uint8)  # no split: every row goes left
        self.value = np.zeros((self.rounds, self.classes, inner + 1))
        self.gain = np.zeros(features)
        prior = np.array([weight[y == c].sum() + 1 for c in range(self.classes)])
        self.base = np.log(prior / prior.sum())
        score = np.tile(self.base, (n, 1))
        truth = np.eye(self.classes)[y]
        for r in range(self.rounds):
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for c in range(self.classes):
                g, h = (p[:, c] - truth[:, c]) * weight, np.maximum(p[:, c] * (1 - p[:, c]), 1e-6) * weight
                leaf = self._grow(binned, flat, g, h, self.feature[r, c], self.threshold[r, c], features)
                sums = [np.bincount(leaf, weights=v, minlength=inner + 1) for v in (g, h)]
                self.value[r, c] = -self.rate * sums[0] / (sums[1] + self.penalty)
                score[:, c] += self.value[r, c][leaf]
        return self

    def _grow(self, binned: np.ndarray, flat: np.ndarray, g: np.ndarray, h: np.ndarray, feature: np.ndarray,
              threshold: np.ndarray, features: int) -> np.ndarray:
        node = np.zeros(len(binned), np.int64)
        for level in range(self.depth):
            first, width = (1 << level) - 1, 1 << level
            cells = width * features * BINS
            at = ((node - first)[:, None] * (features * BINS) + flat).ravel()
            sums = [np.bincount(at, weights=np.repeat(v, features), minlength=cells).reshape(width, features, BINS).cumsum(axis=2)
                    for v in (g, h)]
            whole = [s[:, :, -1:] for s in sums]
            rest = [w - s for w, s in zip(whole, sums)]
            gain = (sums[0] ** 2 / (sums[1] + self.penalty) + rest[0] ** 2 / (rest[1] + self.penalty)
                    - whole[0] ** 2 / (whole[1] + self.penalty))
            gain[(sums[1] < self.least_weight) | (rest[1] < self.least_weight)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            feature[first:first + width] = best // BINS
            threshold[first:first + width] = np.where(good, best % BINS, BINS)
            np.add.at(self.gain, best[good] // BINS, gain.reshape(width, -1)[np.arange(width), best][good])
            right = binned[np.arange(len(binned)), feature[node]] > threshold[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Logarithm of each class's probability, a row a row of ``x``."""
        binned, rows = self._binned(x), np.arange(len(x))
        score = np.tile(self.base, (len(x), 1))
        for r in range(self.rounds):
            for c in range(self.classes):
                feature, threshold = self.feature[r, c], self.threshold[r, c]
                node = np.zeros(len(x), np.int64)
                for _ in range(self.depth):
                    node = 2 * node + 1 + (binned[rows, feature[node]] > threshold[node])
                score[:, c] += self.value[r, c][node - len(feature)]
        top = score.max(axis=1, keepdims=True)
        return score - top - np.log(np.exp(score - top).sum(axis=1, keepdims=True))
