"""Where coefficients of a recursive fit begin, and how firmly."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAX_MAGNITUDE = 1e6


@dataclass(frozen=True)
class Prior:
    """A coefficient, its standard error, and the error of the model that it comes from.

    `relative`: coefficient and standard error are per unit of the target's mean. `constant`: the
    coefficient is the mean of what the other priors leave unexplained, the standard error a share of it."""

    coefficient: float = 0.0
    standard_error: float = 0.5
    rmse: float = 0.2
    relative: bool = False
    constant: bool = False

    def begin(self, y: np.ndarray, unexplained: np.ndarray | None = None) -> tuple[float, float]:
        """Coefficient and inverse information (standard error over rmse, squared) at the start."""
        value, error = self.coefficient, self.standard_error
        if self.relative:
            value, error = (float(np.clip(v / y.mean(), -MAX_MAGNITUDE, MAX_MAGNITUDE)) for v in (value, error))
        if self.constant:
            value = float(unexplained.mean())
            error *= value
        return value, (error / self.rmse) ** 2


def start(priors: list[Prior], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and the diagonal of the inverse information, from the first rows; one prior is constant."""
    constant = [i for i, p in enumerate(priors) if p.constant]
    if len(constant) != 1 or len(priors) != x.shape[1]:
        raise ValueError("one prior a column, and one of them constant")
    coef, spread = np.zeros(len(priors)), np.zeros(len(priors))
    for i, p in enumerate(priors):
        if not p.constant:
            coef[i], spread[i] = p.begin(y)
    at = constant[0]
    coef[at], spread[at] = priors[at].begin(y, y - x @ coef)
    return coef, spread
