"""Gradient-boosted regression trees with logistic loss over binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees: per inner node a feature and a bound (values above go right), per leaf a score."""

    start: float
    depth: int
    feature: np.ndarray  # trees x (2**depth - 1)
    bound: np.ndarray
    leaf: np.ndarray  # trees x 2**depth

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            out += leaf[at - (len(leaf) - 1)]
        return out


def fit(
    x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, l2: float = 1.0,
) -> Trees:
    n, features = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Trees(float(np.log(share / (1 - share))), depth, np.zeros((trees, 2**depth - 1), np.int64),
                  np.full((trees, 2**depth - 1), np.inf), np.zeros((trees, 2**depth)))
    logit = np.full(n, model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            here = at - first
            total_g, total_h = (np.bincount(here, v, width) for v in (g, h))
            best = np.full(width, 1e-6)
            for f in range(features):
                size = len(edges[f]) + 1
                cell = here * size + binned[:, f]
                left_g, left_h = (np.bincount(cell, v, width * size).reshape(width, size).cumsum(axis=1)[:, :-1] for v in (g, h))
                if not left_g.shape[1]:
                    continue
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - (total_g**2 / (total_h + l2))[:, None]
                cut = gain.argmax(axis=1)
                gain = gain[np.arange(width), cut]
                better = gain > best
                best[better] = gain[better]
                model.feature[t, first: first + width][better] = f
                model.bound[t, first: first + width][better] = edges[f][cut[better]]
            at = 2 * at + 1 + (x[np.arange(n), model.feature[t, at]] > model.bound[t, at])
        leaf = at - (2**depth - 1)
        top, low = np.bincount(leaf, g, 2**depth), np.bincount(leaf, h, 2**depth)
        model.leaf[t] = rate * top / (low + l2)
        logit += model.leaf[t][leaf]
    return model
