"""Gradient-boosted trees for several classes, in numpy: binned features, second-order gains."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """Softmax boosting: in each round one tree per class, all of the same depth.

    Splits maximise the second-order gain over histograms of binned features; every tree sees a
    random share of the features. Equal input and seed give an equal model.
    """

    def __init__(
        self, classes: int, rounds: int = 40, depth: int = 4, rate: float = 0.25, share: float = 0.6,
        ridge: float = 1.0, seed: int = 7,
    ):
        self.classes, self.rounds, self.depth, self.rate = classes, rounds, depth, rate
        self.share, self.ridge, self.seed = share, ridge, seed

    def _bin(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, dtype=np.uint8)
        for f, edges in enumerate(self.edges):
            out[:, f] = np.searchsorted(edges, x[:, f])
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        rng = np.random.default_rng(self.seed)
        n, features = x.shape
        weight = np.ones(n) if weight is None else weight
        steps = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], steps, method="lower")) for f in range(features)]
        binned = self._bin(x)
        hot = np.eye(self.classes)[y]
        share = np.maximum((hot * weight[:, None]).sum(0), 1e-9)
        self.start = np.log(share / share.sum())
        score = np.tile(self.start, (n, 1))
        nodes = 2**self.depth - 1
        trees = self.rounds * self.classes
        self.feature = np.zeros((trees, nodes), dtype=np.int32)
        self.cut = np.full((trees, nodes), 255, dtype=np.uint8)  # no value is above it
        self.value = np.zeros((trees, nodes + 1))
        for t in range(trees):
            c = t % self.classes
            if c == 0:
                p = np.exp(score - score.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
            g, h = weight * (p[:, c] - hot[:, c]), weight * np.maximum(p[:, c] * (1 - p[:, c]), 1e-6)
            used = np.sort(rng.choice(features, max(1, int(self.share * features)), replace=False))
            score[:, c] += self._grow(t, binned[:, used], used, g, h)
        return self

    def _grow(self, t: int, x: np.ndarray, used: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        n, features = x.shape
        at = np.zeros(n, dtype=np.int64)  # node within its level
        cells = np.arange(features) * BINS + x
        for level in range(self.depth):
            size = 2**level
            flat = (cells + (at * features * BINS)[:, None]).ravel()
            sums = [
                np.bincount(flat, np.repeat(v, features), size * features * BINS).reshape(size, features, BINS)
                for v in (g, h)
            ]
            left = [s.cumsum(2)[:, :, :-1] for s in sums]
            whole = [s.sum(2, keepdims=True) for s in sums]
            right = [w - s for w, s in zip(whole, left)]
            gain = sum(a**2 / (b + self.ridge) for a, b in (left, right)) - whole[0] ** 2 / (whole[1] + self.ridge)
            gain[(left[1] < 1e-3) | (right[1] < 1e-3)] = 0
            best = gain.reshape(size, -1).argmax(1)
            f, cut = best // (BINS - 1), best % (BINS - 1)
            cut = np.where(gain.reshape(size, -1).max(1) > 1e-6, cut, 255)
            self.feature[t, size - 1 : 2 * size - 1] = used[f]
            self.cut[t, size - 1 : 2 * size - 1] = cut
            at = 2 * at + (x[np.arange(n), f[at]] > cut[at])
        leaves = 2**self.depth
        sums = [np.bincount(at, v, leaves) for v in (g, h)]
        self.value[t] = -self.rate * sums[0] / (sums[1] + self.ridge)
        return self.value[t][at]

    def log_probability(self, x: np.ndarray, step: int = 1 << 16) -> np.ndarray:
        out = np.empty((len(x), self.classes))
        for a in range(0, len(x), step):
            binned = self._bin(x[a : a + step])
            n, features = binned.shape
            flat, base = binned.ravel(), np.arange(n) * features
            score = np.tile(self.start, (n, 1))
            for t in range(len(self.feature)):
                at = np.zeros(n, dtype=np.int64)
                feature, cut = self.feature[t], self.cut[t]
                for _ in range(self.depth):
                    at = 2 * at + 1 + (flat[base + feature[at]] > cut[at])
                score[:, t % self.classes] += self.value[t][at - len(feature)]
            score -= score.max(1, keepdims=True)
            out[a : a + step] = score - np.log(np.exp(score).sum(1, keepdims=True))
        return out
