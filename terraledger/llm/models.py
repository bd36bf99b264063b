"""Small numpy models that several operators fit on bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton's method on standardised features; returns rows (weights, means, deviations) with the intercept first."""
    mean, dev = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / dev])
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = sigmoid(a @ w)
        h = (a.T * np.maximum(p * (1 - p), 1e-6)) @ a + np.diag(penalty)
        move = np.linalg.solve(h, a.T @ (y - p) - penalty * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return np.stack([w, np.r_[0, mean], np.r_[1, dev]])


def logistic(x: np.ndarray, fitted: np.ndarray) -> np.ndarray:
    w, mean, dev = fitted
    return sigmoid(w[0] + ((x - mean[1:]) / dev[1:]) @ w[1:])
