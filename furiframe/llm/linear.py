"""A small logistic regression for the models of this subpackage."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 400, rate: float = 0.05,
                 balance: bool = False) -> tuple[np.ndarray, float]:
    """Weights and bias for soft labels ``y`` in [0, 1], by full-batch Adam on the mean log loss;
    with ``balance`` both classes have the same total weight."""
    x = x.astype(np.float32, copy=False)
    one = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    weight = y * (0.5 / one) + (1 - y) * (0.5 / (1 - one)) if balance else np.ones(len(y))
    w, b = np.zeros(x.shape[1], np.float32), 0.0 if balance else float(np.log(one / (1 - one)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        err = weight * (sigmoid(x @ w + b) - y)
        g = np.append(x.T @ err.astype(np.float32) / len(y) + l2 * w, err.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w -= step[:-1].astype(np.float32)
        b -= float(step[-1])
    return w, b
