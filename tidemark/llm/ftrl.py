"""Follow-the-regularised-leader training with per-coordinate rates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rates:
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0


class Ftrl:
    """FTRL-proximal for one output (logistic) or several (softmax) over sparse examples."""

    def __init__(self, size: int, outputs: int, rates: Rates):
        self.z = np.zeros((size, outputs))
        self.n = np.zeros((size, outputs))
        self.rates = rates

    def weights(self, at=slice(None)) -> np.ndarray:
        r, z, n = self.rates, self.z[at], self.n[at]
        w = -(z - np.sign(z) * r.l1) / ((r.beta + np.sqrt(n)) / r.alpha + r.l2)
        return np.where(np.abs(z) > r.l1, w, 0.0)

    def learn(self, at: np.ndarray, values: np.ndarray, target: np.ndarray) -> None:
        """One example: distinct coordinates, their values, wanted outputs (0 or 1 each)."""
        w = self.weights(at)
        s = values @ w
        if len(s) == 1:
            p = 1 / (1 + np.exp(-np.clip(s, -35, 35)))
        else:
            e = np.exp(s - s.max())
            p = e / e.sum()
        g = values[:, None] * (p - target)[None, :]
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / self.rates.alpha * w
        self.n[at] = grown
