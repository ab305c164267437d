"""Logistic models of a few hundred weights, for bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Weights and intercept (last) by Newton's steps, drawn to ``prior`` (the intercept is not)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    pull = np.full(x.shape[1], strength)
    pull[-1] = 1e-3
    centre = np.append(prior, 0.0)
    w = centre.copy()
    for _ in range(50):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + pull * (w - centre)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        move = np.linalg.solve(bend, slope)
        size = np.abs(move).max()
        w = w - move * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 150, decay: float = 1e-4) -> np.ndarray:
    """Weights (features x classes) by accelerated gradient descent."""
    target = np.zeros((len(y), classes))
    target[np.arange(len(y)), y] = 1
    rate = 4.0 / max((x * x).sum(1).max(), 1e-9)
    w = last = np.zeros((x.shape[1], classes))
    for t in range(steps):
        ahead = w + (w - last) * t / (t + 3)
        slope = x.T @ (softmax(x @ ahead) - target) / len(y) + decay * ahead
        last, w = w, ahead - rate * slope
    return w
