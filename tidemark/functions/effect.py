"""Relative effect of a parent forecast on its leaves: causal reference, centre and clip."""

from __future__ import annotations

import numpy as np

from tidemark.config import Effect


def relative_effect(actual: np.ndarray, forecast: np.ndarray, block: np.ndarray, known: np.ndarray | None = None, cfg: Effect = Effect()) -> dict[str, np.ndarray]:
    """effect (log), reference, centre and raw relative effect of each row; rows of a block share reference and centre.

    `known` marks rows whose actual value is known (all, unless the horizon lies ahead)."""
    n = len(actual)
    known = np.ones(n, dtype=bool) if known is None else known
    supported = known & np.isfinite(actual) & (actual > 0)
    raw = np.log1p(np.maximum(np.nan_to_num(forecast, nan=0.0), 0.0))
    reference, relative, centre = np.zeros(n), np.zeros(n), np.zeros(n)
    firsts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if n else []
    for first, end in zip(firsts, [*firsts[1:], n]):
        window = np.arange(max(0, first - cfg.lookback), first)
        points = actual[window][supported[window]]
        if len(points) < cfg.min_points:
            points = actual[:first][supported[:first]]
        if not len(points):
            points = forecast[:first][np.nan_to_num(forecast[:first], nan=0.0) > 0]
        level = float(np.median(points)) if len(points) else 0.0
        reference[first:end] = level
        relative[first:end] = raw[first:end] - np.log1p(level) if level > 0 else 0.0
        own = float(np.median(relative[first:end]))
        before = relative[window][supported[window]]
        if len(before) >= cfg.min_points:
            prior = float(np.median(before))
            moved = end - first >= cfg.min_points and abs(own - prior) > np.log(cfg.regime_ratio)
            centre[first:end] = own if moved else prior
        else:
            centre[first:end] = own
    return {"effect": np.clip(relative - centre, np.log(cfg.low), np.log(cfg.high)), "reference": reference, "centre": centre, "relative": relative}
