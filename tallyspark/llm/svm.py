"""Linear support vector machine (squared hinge) in numpy."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-4,
        rounds: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias for labels -1 and 1, by accelerated gradient steps over all rows."""
    n, d = x.shape
    x = np.hstack([x, np.ones((n, 1), x.dtype)]).astype(np.float32)
    s = (np.ones(n) if weight is None else weight).astype(np.float32)
    s /= max(s.sum(), 1e-9)
    y = y.astype(np.float32)
    v = np.ones(d + 1, np.float32)
    for _ in range(12):                                      # largest curvature, by power iteration
        v = x.T @ (s * (x @ v))
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    step = 1 / (2 * top + 2 * ridge)
    w = last = np.zeros(d + 1, np.float32)
    for k in range(rounds):
        z = w + k / (k + 3) * (w - last)
        slack = np.maximum(0, 1 - y * (x @ z))
        g = -2 * (x.T @ (s * y * slack)) + 2 * ridge * np.append(z[:-1], 0)
        last, w = w, (z - step * g).astype(np.float32)
    return w[:-1], float(w[-1])


def fit_each(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """``fit`` of several machines over the same rows: labels and weights have a column for each."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float32)
    s = weight.astype(np.float32) / np.maximum(weight.sum(0), 1e-9).astype(np.float32)
    y = y.astype(np.float32)
    v = np.ones((x.shape[1], y.shape[1]), np.float32)
    for _ in range(12):
        v = x.T @ (s * (x @ v))
        top = np.linalg.norm(v, axis=0)
        top[top == 0] = 1
        v /= top
    step = 1 / (2 * top + 2 * ridge)
    w = last = np.zeros_like(v)
    for k in range(rounds):
        z = w + k / (k + 3) * (w - last)
        slack = np.maximum(0, 1 - y * (x @ z))
        g = -2 * (x.T @ (s * y * slack))
        g[:-1] += 2 * ridge * z[:-1]
        last, w = w, (z - step * g).astype(np.float32)
    return w[:-1], w[-1]


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """a and b of 1 / (1 + exp(-(a * margin + b))), by Newton steps; ``y``: 0 or 1."""
    x = np.stack([margin, np.ones_like(margin)], 1).astype(np.float64)
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]) + 1e-3 * np.eye(2)
        theta -= np.linalg.solve(h, x.T @ (p - y) + 1e-3 * theta)
    return float(theta[0]), float(theta[1])
