"""Logistic regression over a few binary features, with weights per row and pairs to keep equal."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Rows:
    """Sparse rows: the feature numbers of each, and their values, by default 1."""

    def __init__(self, rows: list[np.ndarray], n_features: int, values: list[np.ndarray] | None = None):
        self.items = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.values = None if values is None else np.concatenate([np.zeros(0), *values])
        self.n, self.n_features = len(rows), n_features

    def dot(self, w: np.ndarray) -> np.ndarray:
        x = w[self.items]
        return np.bincount(self.row, weights=x if self.values is None else x * self.values, minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        x = g[self.row]
        return np.bincount(self.items, weights=x if self.values is None else x * self.values, minlength=self.n_features)

    def largest_square(self) -> float:
        """The largest squared length of a row."""
        return np.bincount(self.row, weights=None if self.values is None else self.values ** 2, minlength=max(self.n, 1)).max(initial=0)


def fit(rows: Rows, target: np.ndarray, l2: float, steps: int = 400,
        left: Rows | None = None, right: Rows | None = None, equal: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias minimising log loss + l2/2 |w|^2 + equal/2 sum (w.left - w.right)^2.

    ``target`` holds probabilities. Accelerated gradient steps with a fixed step from the
    loss's curvature bound, so the result is the same on every run.
    """
    n = max(rows.n, 1)
    prior = float(np.clip(target.mean(), 1e-4, 1 - 1e-4)) if rows.n else 0.5
    w, b = np.zeros(rows.n_features), float(np.log(prior / (1 - prior)))
    bound = 0.25 * (rows.largest_square() + 1) + l2 / n
    if left is not None and left.n:
        width = np.bincount(left.row, minlength=left.n) + np.bincount(right.row, minlength=left.n)
        bound += equal * float(width.sum()) / n
    step, vw, vb, t = 1.0 / bound, w.copy(), b, 1.0
    for _ in range(steps):
        error = (sigmoid(rows.dot(vw) + vb) - target) / n
        gw, gb = rows.back(error) + l2 / n * vw, float(error.sum())
        if left is not None and left.n:
            gap = equal / n * (left.dot(vw) - right.dot(vw))
            gw += left.back(gap) - right.back(gap)
        nw, nb = vw - step * gw, vb - step * gb
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b
