"""Logistic calibration of a few numbers to a probability, fitted on bounded weighted rows."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients, the constant last, by Newton steps. ``y`` may hold one class only."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = weight / max(weight.sum(), 1e-12)
    spread = np.append(np.maximum(x[:, :-1].std(axis=0), 1e-9), 1.0) if len(x) else np.ones(x.shape[1])
    z = x / spread
    b = np.zeros(x.shape[1])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        grad = z.T @ (weight * (p - y)) + penalty * b
        hess = (z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        b -= step
        if np.abs(step).max() < 1e-9:
            break
    return b / spread


def probability(x: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    z = x @ coefficients[:-1] + coefficients[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
