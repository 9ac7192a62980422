"""Multinomial logistic regression by follow-the-regularised-leader with elastic-net penalties."""

from __future__ import annotations

import numpy as np


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, dims: int,
        l1: float = 0.2, l2: float = 0.01, alpha: float = 0.5, beta: float = 1.0,
        epochs: int = 4, seed: int = 7) -> np.ndarray:
    """Weights (classes x dims) from sparse rows (indices, values); most are exactly zero."""
    z, n = np.zeros((classes, dims)), np.zeros((classes, dims))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0)
        return -shrunk / ((beta + np.sqrt(ni)) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            zi, ni = z[:, at], n[:, at]
            w = weights(zi, ni)
            g = softmax(w @ x)
            g[y[i]] -= 1
            g = g[:, None] * x
            grown = ni + g * g
            z[:, at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[:, at] = grown
    return weights(z, n)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on held-back rows."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 200))
    loss = [-np.log(softmax(scores / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])
