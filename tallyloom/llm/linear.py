"""A small logistic regression and a rising curve, for calibration on a bounded number of rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class Logistic:
    """Weights on standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid((x - self.mean) / self.scale @ self.weights + self.bias)


def fit_logistic(
    x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50, tolerance: float = 1e-8, copies: np.ndarray | None = None
) -> Logistic:
    """Newton steps on the penalised likelihood until the weights settle; a row stands for ``copies`` equal ones."""
    width = x.shape[1]
    copies = np.ones(len(x)) if copies is None else copies
    if len(x) == 0 or y.min() == y.max():
        share = (copies @ y + 0.5) / (copies.sum() + 1)
        return Logistic(np.zeros(width), np.ones(width), np.zeros(width), float(np.log(share / (1 - share))))
    mean = np.average(x, axis=0, weights=copies)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=copies))
    scale[scale == 0] = 1.0
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.diag([ridge] * width + [1e-6])
    w = np.zeros(width + 1)
    for _ in range(steps):
        p = sigmoid(z @ w)
        move = np.linalg.solve((z * (copies * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (copies * (y - p)) - penalty @ w)
        w += move
        if np.abs(move).max() < tolerance:
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]))


@dataclass(frozen=True)
class RisingCurve:
    """Piecewise linear, never falling shares at ascending places."""

    places: np.ndarray
    shares: np.ndarray
    # Part of the value that is left as it was, so that no two different values become one.
    kept: float = 0.02

    def predict(self, p: np.ndarray) -> np.ndarray:
        if not len(self.places):
            return p
        return (1 - self.kept) * np.interp(p, self.places, self.shares) + self.kept * p


def fit_rising_curve(p: np.ndarray, y: np.ndarray, copies: np.ndarray | None = None) -> RisingCurve:
    """Shares of ones over ``p`` by pooling neighbours that fall (isotonic regression); a row stands for ``copies`` equal ones.

    A pool of ``n`` rows with ``k`` ones has the share ``(k + 1/2) / (n + 1)``, pools being joined until these rise too. Rows of
    one kind only, or none, give no curve.
    """
    copies = np.ones(len(p)) if copies is None else copies
    if len(p) == 0 or y.min() == y.max():
        return RisingCurve(np.zeros(0), np.zeros(0))
    values, at = np.unique(p, return_inverse=True)
    n = np.bincount(at, copies, len(values))
    ones = np.bincount(at, copies * y, len(values))
    pools: list[list[float]] = []
    for value, count, some in zip(values, n, ones):
        pools.append([value * count, count, some])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    joined: list[list[float]] = []
    for pool in pools:
        joined.append(pool)
        while len(joined) > 1 and (joined[-2][2] + 0.5) / (joined[-2][1] + 1) >= (joined[-1][2] + 0.5) / (joined[-1][1] + 1):
            last = joined.pop()
            joined[-1] = [a + b for a, b in zip(joined[-1], last)]
    total, count, some = np.array(joined).T
    return RisingCurve(total / count, (some + 0.5) / (count + 1))
