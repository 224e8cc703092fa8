"""Recursive least squares with forgetting, in NumPy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tidemark.functions.priors import Prior, start


def coefficient_path(x: np.ndarray, y: np.ndarray, decay: float, min_y: float, seed: int, prior_scale: float = 0.5, weights: np.ndarray | Callable[[np.ndarray], np.ndarray] | None = None, slopes: np.ndarray | None = None, begin: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Coefficients after each row. The first column is the intercept.

    Slopes begin at 0 (or `slopes`), the intercept at the mean of the first `seed` targets less
    what the slopes explain; the inverse information begins diagonal, `prior_scale` a column and
    `prior_scale` times the intercept for the first. `begin` gives coefficients and that diagonal
    instead. `weights`: a weight a row, or a function of the targets. Rows with y <= min_y change nothing.
    """
    weights = weights(y) if callable(weights) else weights
    n, p = x.shape
    coef = np.zeros(p) if slopes is None else np.concatenate([[0.0], slopes])
    coef[0] = float((y[:seed] - x[:seed, 1:] @ coef[1:]).mean()) if n else 0.0
    spread = np.eye(p) * prior_scale
    spread[0, 0] = prior_scale * coef[0]
    if begin is not None:
        coef, spread = begin[0].astype(float), np.diag(begin[1]).astype(float)
    path, outer = np.empty((n, p)), np.empty((p, p))
    for i in range(n):
        if y[i] > min_y:
            row = x[i]
            w = 1.0 if weights is None else weights[i]
            left = w * (row @ spread)
            right = spread @ row
            gain = 1.0 / (decay + left @ row)
            error = y[i] - row @ coef
            np.outer(right, left, out=outer)  # in place: no p x p array a row
            outer *= gain
            spread -= outer
            spread /= decay
            coef += gain * error * left
        path[i] = coef
    return path


def log_weighting(y: np.ndarray) -> np.ndarray:
    """Weight of rows in log space: sqrt(exp(y) / y)."""
    return np.sqrt(np.exp(y) / y)


def ahead(x: np.ndarray, path: np.ndarray, skip: int | None = None, horizon: int = 12) -> list[np.ndarray]:
    """Of each row's coefficients the forecasts of this row and those after it, `horizon` of them or as far as rows go; none for the first `skip` rows."""
    skip = min(x.shape) if skip is None else skip
    return [x[i : i + horizon] @ path[i] if i >= skip else np.zeros(0) for i in range(len(x))]


def behind(x: np.ndarray, path: np.ndarray, skip: int | None = None) -> list[np.ndarray]:
    """Of each row's coefficients the fitted values of all rows before it; none for the first `skip` rows."""
    skip = min(x.shape) if skip is None else skip
    return [x[:i] @ path[i] if i >= skip else np.zeros(0) for i in range(len(x))]


def lagged(history: np.ndarray) -> np.ndarray:
    """Lag 7, lag 28, mean of 7 and mean of 28 earlier values; 0 where there is none."""
    n = len(history)
    out = [history[-7] if n >= 7 else 0.0, history[-28] if n >= 28 else 0.0]
    return np.asarray([*out, history[-7:].mean() if n else 0.0, history[-28:].mean() if n else 0.0])


def lag_matrix(y: np.ndarray) -> np.ndarray:
    return np.stack([lagged(y[:i]) for i in range(len(y))]) if len(y) else np.zeros((0, 4))


def predict_log_base(x: np.ndarray, coef: np.ndarray) -> np.ndarray:
    return np.expm1(np.clip(x @ coef, 0.0, 30.0))


def predict_log_ar(x: np.ndarray, coef: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Recursive forecast: each step's unrounded linear predictor feeds the lags of the next."""
    history = list(tail[-28:])
    out = np.empty(len(x))
    p = x.shape[1]
    for i in range(len(x)):
        z = float(np.clip(x[i] @ coef[:p] + lagged(np.asarray(history)) @ coef[p:], 0.0, 30.0))
        history = [*history, z][-28:]
        out[i] = np.expm1(z)
    return out


class RecursiveLeastSquares:
    """Checked front of coefficient_path."""

    def __init__(self, decay: float = 0.995, constant_priors: int = 1, metrics: bool = False, priors: list[Prior] | None = None, weighting: Callable[[np.ndarray], np.ndarray] | None = None):
        if not 0.0 < decay <= 1.0:
            raise ValueError("the forgetting factor lies in (0, 1]")
        if constant_priors != 1 or (priors is not None and sum(p.constant for p in priors) != 1):
            raise ValueError("one constant prior is needed")
        if metrics:
            raise NotImplementedError("metrics of the fit are not kept")
        self.decay, self.priors, self.weighting = decay, priors, weighting
        self.path: np.ndarray | None = None

    def fit(self, x, y, seed: int = 28, min_y: float = 0.0, weights=None) -> RecursiveLeastSquares:
        x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
        if x.ndim != 2 or len(x) != len(y):
            raise ValueError("x has a row for each y")
        if not (np.isfinite(x).all() and np.isfinite(y).all()):
            raise ValueError("x and y are finite")
        begin = start(self.priors, x[:seed], y[:seed]) if self.priors else None
        self.path = coefficient_path(x, y, self.decay, min_y, seed, weights=self.weighting if weights is None else weights, begin=begin)
        return self

    def forecasts(self, x, horizon: int = 12, skip: int | None = None) -> list[np.ndarray]:
        """Multi-horizon forecasts from the coefficients behind each row."""
        if self.path is None:
            raise ValueError("not fitted")
        return ahead(np.asarray(x, dtype=float), self.path, skip, horizon)

    def fit_stacked(self, pairs, seed: int = 28, min_y: float = 0.0) -> list[np.ndarray]:
        return [self.fit(x, y, seed, min_y).path for x, y in pairs]

    def predict(self, x, row: int = -1) -> np.ndarray:
        if self.path is None:
            raise ValueError("not fitted")
        return np.asarray(x, dtype=float) @ self.path[row]
