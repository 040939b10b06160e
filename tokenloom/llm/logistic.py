"""Small logistic regression on the driver, for bounded samples."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Ridge logistic regression by Newton steps on standardised columns."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, steps: int = 25):
        self.mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        self.scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0) if len(x) else np.ones(x.shape[1])
        w = np.ones(len(x)) if weight is None else weight
        z = np.hstack([np.ones((len(x), 1)), (x - self.mean) / self.scale])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-3
        self.beta = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
            grad = z.T @ (w * (y - p)) - penalty * self.beta
            hess = (z * (w * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hess, grad)
            self.beta += np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-6:
                break

    def raw(self) -> tuple[float, np.ndarray]:
        """(constant, coefficients) for columns as they are."""
        c = self.beta[1:] / self.scale
        return float(self.beta[0] - (c * self.mean).sum()), c

    def logit(self, x: np.ndarray) -> np.ndarray:
        c, b = self.raw()
        return np.clip(c + x @ b, -30, 30)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))
