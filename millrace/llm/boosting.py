"""Gradient boosted trees for two classes on small numpy matrices, and monotone calibration of their scores."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Tree:
    """A complete tree: split k sends a row to 2k+1 if its feature is at most the cut, else to 2k+2."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(int(np.log2(len(self.leaf)))):
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.cut[node])
        return self.leaf[node - len(self.feature)]


@dataclass
class Model:
    start: float
    trees: list[Tree]
    knots: np.ndarray  # scores and the calibrated probabilities from each on
    heights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t(x) for t in self.trees), np.zeros(len(x)))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.zeros(len(x))
        return self.heights[np.maximum(0, np.searchsorted(self.knots, self.scores(x), side="right") - 1)]


def _grow(x: np.ndarray, binned: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, depth: int,
          rate: float, least: float) -> Tree:
    splits = 2 ** depth - 1
    feature, cut = np.zeros(splits, np.int64), np.full(splits, np.inf)
    node = np.zeros(len(x), np.int64)
    for level in range(depth):
        base, width = 2 ** level - 1, 2 ** level
        best = np.full(width, 1e-9)
        for f, edge in enumerate(edges):
            if not len(edge):
                continue
            key = (node - base) * BINS + binned[:, f]
            g = np.cumsum(np.bincount(key, slope, width * BINS).reshape(width, BINS), axis=1)
            h = np.cumsum(np.bincount(key, curve, width * BINS).reshape(width, BINS), axis=1)
            total_g, total_h = g[:, -1:], h[:, -1:]
            gain = g ** 2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g ** 2 / (total_h + 1)
            gain[(h < least) | (total_h - h < least)] = 0
            gain[:, len(edge):] = 0
            at = gain.argmax(axis=1)
            top = gain[np.arange(width), at]
            for k in np.flatnonzero(top > best):
                best[k], feature[base + k], cut[base + k] = top[k], f, edge[at[k]]
        node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
    leaf = node - splits
    g, h = np.bincount(leaf, slope, splits + 1), np.bincount(leaf, curve, splits + 1)
    return Tree(feature, cut, -rate * g / (h + 1))


def fit(x: np.ndarray, y: np.ndarray, held_out: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2) -> Model:
    """Trees on the rows that are not held out; calibration by pooling adjacent violators on those that are."""
    a, b = ~held_out, held_out
    none = np.zeros(0)
    if len(np.unique(y[a])) < 2 or not b.any():
        return Model(0.0, [], none, none)
    share = float(y[a].mean())
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS)[1:-1])) for col in x[a].T]
    edges = [e[e < col.max()] for e, col in zip(edges, x[a].T)]
    binned = np.stack([np.searchsorted(e, col) for e, col in zip(edges, x[a].T)], axis=1)
    trees, score = [], np.full(int(a.sum()), start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        trees.append(_grow(x[a], binned, edges, p - y[a], p * (1 - p), depth, rate, 1.0))
        score = score + trees[-1](x[a])
    model = Model(start, trees, none, none)
    scores = model.scores(x[b])
    order = np.argsort(scores, kind="stable")
    pools: list[list[float]] = []
    for s, label in zip(scores[order].tolist(), y[b][order].tolist()):
        pools.append([s, label, 1.0])
        while len(pools) > 1 and (pools[-2][0] == pools[-1][0] or pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]):
            _, good, n = pools.pop()
            pools[-1][1] += good
            pools[-1][2] += n
    # one negative is added to every pool, so that small pools do not claim certainty
    model.knots = np.array([p[0] for p in pools])
    model.heights = np.maximum.accumulate([p[1] / (p[2] + 1) for p in pools])
    return model
