"""Walk-forward exponential smoothing of one leaf, with guards and traces."""

from __future__ import annotations

import numpy as np

from tidemark.config import Ses

HISTORY, HOLDOUT, AHEAD = 0, 1, 2


def _forecast(level, effect, cap):
    return np.minimum(np.maximum(np.expm1(np.log1p(level) + effect), 0.0), cap)


def gap_factor(gap: float, cfg: Ses) -> float:
    if gap >= cfg.dormant_gap:
        return cfg.dormant_factor
    return max(cfg.decay_floor, cfg.decay ** min(gap, cfg.decay_cap)) if gap >= 1 else 1.0


def walk_forward(y, index, block, period, effect, initial: float, warmup, support=None, alphas=None, cfg: Ses = Ses(), gap_aware: bool = True, records: list | None = None) -> dict[str, np.ndarray]:
    """Forecast and traces of each row (in order of block and day); state moves on when a block closes.

    index: the store's observable day number; period: 0 history, 1 holdout, 2 ahead; effect: log driver
    factor; warmup: rows that only have the initial level; support: rows that score and update (y > 0).
    `records` gets, of each block with scored rows, its period and number, absolute and signed errors
    and sales of every alpha.
    """
    y, index, block, period, effect = (np.asarray(a) for a in (y, index, block, period, effect))
    warmup = np.asarray(warmup, dtype=bool)
    support = np.asarray(y > 0 if support is None else support, dtype=bool) & np.isfinite(y) & (period != AHEAD)
    alphas = np.asarray(cfg.alphas if alphas is None else alphas, dtype=float)
    default = int(np.argmin(np.abs(alphas - cfg.default_alpha)))
    n = len(y)
    out = {k: np.full(n, np.nan) for k in ("forecast", "level", "alpha", "cap", "gap", "factor")}
    eligible = np.zeros(n, dtype=bool)
    state = np.full(len(alphas), float(initial))
    error, sales = np.zeros(len(alphas)), 0.0
    chosen, frozen, anchor, frozen_factor, reactivated = default, False, None, None, False
    top, total, count, recent, last = 0.0, 0.0, 0, [], None
    firsts = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (period[1:] != period[:-1])])) if n else np.zeros(0, int)
    for first, end in zip(firsts, [*firsts[1:], n]):
        if period[first] == HISTORY:
            chosen = default
            if sales > 0:
                best, chosen = np.inf, default
                for k in range(len(alphas)):
                    if error[k] / sales < best - 1e-15:
                        best, chosen = error[k] / sales, k
        elif not frozen:
            if len(recent) >= cfg.anchor_points:
                state = np.minimum(state, cfg.anchor_clamp * float(np.median(recent[-28:])))
            anchor, frozen = state.copy(), True
        gap = max(0.0, float(index[first] - last - 1)) if last is not None else 0.0
        factor = gap_factor(gap, cfg) if gap_aware else 1.0
        if frozen:
            frozen_factor = factor if frozen_factor is None else frozen_factor
            factor = frozen_factor
        mean = total / count if count else 0.0
        cap = cfg.max_multiple * (top if count else initial)
        if count:
            cap = min(cap, cfg.mean_multiple * mean)
            if gap >= cfg.dormant_gap:
                cap = min(cap, cfg.gap_mean_multiple * mean)
        rows = np.arange(first, end)
        levels = np.where(warmup[rows], initial, state[chosen] * factor)
        out["level"][rows], out["factor"][rows] = levels, np.where(warmup[rows], 1.0, factor)
        out["alpha"][rows], out["cap"][rows], out["gap"][rows] = alphas[chosen], cap, gap
        out["forecast"][rows] = _forecast(levels, effect[rows], cap)
        eligible[rows] = ~warmup[rows] & (period[rows] != AHEAD)
        scored = rows[support[rows] & ~warmup[rows]]
        if len(scored) and (period[first] == HISTORY or records is not None):
            miss = _forecast(state[None] * factor, effect[scored][:, None], cap) - y[scored][:, None]
            missed = np.abs(miss).sum(axis=0)
            if period[first] == HISTORY:
                error, sales = error + missed, sales + float(y[scored].sum())
            if records is not None:
                records.append((int(period[first]), int(block[first]), missed, miss.sum(axis=0), float(y[scored].sum())))
        for i in rows[support[rows]]:
            seen = float(np.expm1(np.log1p(y[i]) - effect[i]))
            quiet = float(index[i] - last - 1) if last is not None else 0.0
            if quiet >= cfg.dormant_gap:
                state = np.clip(state, seen / 2, 2 * seen)
                rate, target = np.minimum(alphas, cfg.reactivation_alpha), np.full(len(alphas), seen)
                if period[i] == HOLDOUT:
                    reactivated, frozen_factor = True, 1.0
            else:
                rate = alphas
                target = np.where(state > 0, np.clip(seen, cfg.clip_low * state, cfg.clip_high * state), seen)
            state = rate * target + (1 - rate) * state
            if period[i] == HOLDOUT and anchor is not None:
                low = 0.0 if reactivated else cfg.envelope[0] * anchor
                state = np.clip(state, low, cfg.envelope[1] * anchor)
            recent = [*recent, seen][-28:]
            top, total, count, last = max(top, float(y[i])), total + float(y[i]), count + 1, index[i]
    out["eligible"] = eligible
    return out
