"""Second versions: the recurrences written out plainly, row by row, and held against the kernels."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest

from tidemark.config import Rls, Ses
from tidemark.functions import dates as D
from tidemark.functions import rls as R
from tidemark.functions import ses as S
from tidemark.functions.priors import Prior, start
from tidemark.operators import calendar as K
from tidemark.operators import nodes as N


def plain_walk(y, index, block, period, effect, initial, warm, alphas, cfg=Ses()):
    """Scalars and lists only; a state per smoothing weight."""
    def level_to_forecast(level, e, cap):
        return min(max(math.expm1(math.log1p(level) + e), 0.0), cap)

    state = {a: initial for a in alphas}
    errors, sales = dict.fromkeys(alphas, 0.0), 0.0
    anchor = frozen_factor = last = None
    reactivated, frozen = False, False
    seen_values, highest, total, count = [], 0.0, 0.0, 0
    chosen = min(alphas, key=lambda a: abs(a - cfg.default_alpha))
    out, records, i = [], [], 0
    while i < len(y):
        j = i
        while j < len(y) and (block[j], period[j]) == (block[i], period[i]):
            j += 1
        if period[i] == S.HISTORY:
            chosen = min(alphas, key=lambda a: abs(a - cfg.default_alpha))
            if sales > 0:
                chosen = min(alphas, key=lambda a: (errors[a] / sales, alphas.index(a)))
        elif not frozen:
            frozen = True
            if len(seen_values) >= cfg.anchor_points:
                most = cfg.anchor_clamp * statistics.median(seen_values[-28:])
                state = {a: min(s, most) for a, s in state.items()}
            anchor = dict(state)
        gap = max(0.0, index[i] - last - 1) if last is not None else 0.0
        factor = cfg.dormant_factor if gap >= cfg.dormant_gap else max(cfg.decay_floor, cfg.decay ** min(gap, cfg.decay_cap)) if gap >= 1 else 1.0
        if frozen:
            if frozen_factor is None:
                frozen_factor = factor
            factor = frozen_factor
        cap = cfg.max_multiple * (highest if count else initial)
        if count:
            cap = min(cap, cfg.mean_multiple * total / count)
            if gap >= cfg.dormant_gap:
                cap = min(cap, cfg.gap_mean_multiple * total / count)
        for r in range(i, j):
            level = initial if warm[r] else state[chosen] * factor
            out.append((level_to_forecast(level, effect[r], cap), level, chosen, cap, gap))
        use = [r for r in range(i, j) if period[r] != S.AHEAD and y[r] > 0]
        scored = [r for r in use if not warm[r]]
        if scored:
            missed = {a: sum(abs(level_to_forecast(state[a] * factor, effect[r], cap) - y[r]) for r in scored) for a in alphas}
            records.append((period[i], block[i], [missed[a] for a in alphas], sum(y[r] for r in scored)))
            if period[i] == S.HISTORY:
                sales += sum(y[r] for r in scored)
                errors = {a: errors[a] + missed[a] for a in alphas}
        for r in use:
            seen = math.expm1(math.log1p(y[r]) - effect[r])
            quiet = index[r] - last - 1 if last is not None else 0
            if quiet >= cfg.dormant_gap and period[r] == S.HOLDOUT:
                reactivated, frozen_factor = True, 1.0
            for a in alphas:
                s = state[a]
                if quiet >= cfg.dormant_gap:
                    s = min(max(s, seen / 2), 2 * seen)
                    rate, target = min(a, cfg.reactivation_alpha), seen
                else:
                    rate, target = a, min(max(seen, cfg.clip_low * s), cfg.clip_high * s) if s > 0 else seen
                s = rate * target + (1 - rate) * s
                if period[r] == S.HOLDOUT and anchor is not None:
                    s = min(max(s, 0.0 if reactivated else cfg.envelope[0] * anchor[a]), cfg.envelope[1] * anchor[a])
                state[a] = s
            seen_values.append(seen)
            highest, total, count, last = max(highest, y[r]), total + y[r], count + 1, index[r]
        i = j
    return out, records


@pytest.mark.parametrize("seed", range(12))
def test_walk_forward_equals_a_plain_walk(seed):
    rng = random.Random(seed)
    n = rng.randint(30, 160)
    steps = [rng.choice([1, 1, 1, 2, 5, 40 if rng.random() < 0.2 else 1]) for _ in range(n)]
    index = list(np.cumsum(steps))
    y = [0.0 if rng.random() < 0.3 else float(rng.randint(1, 40)) for _ in range(n)]
    cut = int(n * 0.8)
    period = [S.HISTORY if i < cut else S.HOLDOUT if i < n - 5 else S.AHEAD for i in range(n)]
    block = [i // rng.choice([7]) for i in range(n)]
    effect = [rng.uniform(-0.5, 0.5) for _ in range(n)]
    warm = [i < 10 for i in range(n)]
    effect = [0.0 if w else e for w, e in zip(warm, effect)]
    alphas = (0.05, 0.1, 0.3, 0.8)
    records = []
    got = S.walk_forward(y, index, block, period, effect, 8.0, warm, alphas=alphas, records=records)
    want, plain_records = plain_walk(y, index, block, period, effect, 8.0, warm, alphas)
    for key, at in (("forecast", 0), ("level", 1), ("alpha", 2), ("cap", 3), ("gap", 4)):
        assert np.allclose(got[key], [w[at] for w in want], rtol=1e-9, atol=1e-12), key
    assert [(r[0], r[1]) for r in records] == [(r[0], r[1]) for r in plain_records]
    assert all(np.allclose(r[2], p[2]) and math.isclose(r[4], p[3]) for r, p in zip(records, plain_records))


def node_frame(seed=3, history=168, extra=56):
    rng = np.random.default_rng(seed)
    n = history + extra
    frame = pd.DataFrame({"unique_id": "1", "section": "1", "store": None, "ds": [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(n)]})
    frame["period_type"] = ["in_sample" if i < history else "out_sample" if i < history + 28 else "forecast_only" for i in range(n)]
    for c in N.CALENDAR:
        frame[c] = rng.integers(0, 2, n) * (rng.random(n) < 0.2)
    for c in N.PRICES:
        frame[c] = rng.uniform(0.5, 1.5, n)
    frame["y"] = np.where(np.arange(n) < history + 28, rng.integers(0, 60, n), 0).astype(float)
    frame["value"] = frame["y"] * 3
    return frame


def plain_node(frame, target, rls=Rls()):
    """One target's forecasts, block by block of 28 days, refitting from the start for every block."""
    period, n = list(frame["period_type"]), len(frame)
    known = sum(p != "forecast_only" for p in period)
    x = np.column_stack([np.ones(n), frame[N.CALENDAR].to_numpy(float)] + ([frame[N.PRICES].to_numpy(float)] if target == "y" else []))
    z = np.log1p(frame[target].to_numpy(float))
    floor = rls.min_y_units if target == "y" else rls.min_y_value
    candidates = [(m, d) for m in rls.modes for d in rls.decays]

    def lag(history):
        return [history[-7] if len(history) >= 7 else 0.0, history[-28] if len(history) >= 28 else 0.0, np.mean(history[-7:]) if len(history) else 0.0, np.mean(history[-28:]) if len(history) else 0.0]

    def fit(mode, decay, upto):
        rows = [np.concatenate([x[i], lag(z[:i])]) if mode == "ar" else x[i] for i in range(upto)]
        coef = np.zeros(len(rows[0]))
        coef[0] = z[:28].mean()
        b = np.diag([0.5 * coef[0], *[0.5] * (len(coef) - 1)])
        for i in range(upto):
            if z[i] > floor:
                r = rows[i]
                k = b @ r / (decay + r @ b @ r)
                coef = coef + k * (z[i] - r @ coef)
                b = (b - np.outer(k, r @ b)) / decay
        return coef

    def forecast(mode, coef, a, end, upto):
        if mode == "base":
            return [math.expm1(min(max(float(x[i] @ coef), 0.0), 30.0)) for i in range(a, end)]
        history, out = list(z[:upto]), []
        for i in range(a, end):
            v = min(max(float(np.concatenate([x[i], lag(history)]) @ coef), 0.0), 30.0)
            history.append(v)
            out.append(math.expm1(v))
        return out

    hat, error, chosen, frozen, at = [None] * n, dict.fromkeys(candidates, 0.0), rls.default, False, 28
    while at < n:
        end = at
        while end < n and end - at < 28 and period[end] == period[at]:
            end += 1
        upto = min(at, known)
        if (period[at] == "in_sample" or not frozen) and any(error.values()):
            chosen = min(candidates, key=lambda c: (error[c], c))
        frozen = frozen or period[at] != "in_sample"
        for c in candidates if period[at] == "in_sample" else [chosen]:
            f = forecast(c[0], fit(*c, upto), at, end, upto)
            if c == chosen:
                hat[at:end] = [round(v, 0 if target == "y" else 2) for v in f]
            error[c] += sum(abs(f[i - at] - frame[target][i]) for i in range(at, end) if frame["y"][i] > 0)
        at = end
    return hat


def test_forecast_node_equals_a_plain_refit():
    frame = node_frame()
    out = N.forecast_node(frame, (28,))
    for target, hat in (("y", "yhat"), ("value", "valuehat")):
        want = plain_node(frame, target)
        got = [None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v) for v in out[hat]]
        assert [g is None for g in got] == [w is None for w in want]
        assert all(w is None or abs(g - w) <= 0.0101 * (1 if target == "value" else 0) + 1e-9 for g, w in zip(got, want))


def test_node_forecasts_see_no_later_day_and_share_history_over_cadences():
    frame = node_frame()
    changed = frame.copy()
    changed.loc[168:195, ["y", "value"]] *= 5
    a, b = N.forecast_node(frame, (7, 28)), N.forecast_node(changed, (7, 28))
    for out in (a, b):
        windows = out[out["period_type"] == "in_sample"].groupby("cadence")["ds"].agg(["min", "max"])
        assert (windows.iloc[0] == windows.iloc[1]).all()
    early = a["ds"] < dt.date(2024, 1, 1) + dt.timedelta(days=169)
    assert a.loc[early, "yhat"].equals(b.loc[early, "yhat"]) and not a["yhat"].equals(b["yhat"])
    assert not np.allclose(a["driver_effect"], a["driver_effect_value"])


def test_block_scores_and_driver_screen_match_the_path():
    frame = node_frame(4)
    x = N.designs_of(frame)["y"]
    period = frame["period_type"].to_numpy()
    known = int((period != "forecast_only").sum())
    z = np.log1p(frame["y"].to_numpy(float))
    path = R.coefficient_path(x[:known], z[:known], 0.995, 1.0, 28)
    scores = N.block_scores(x, frame, "y", "base", 0.995, 28, Rls())
    assert [s[0] for s in scores] == ["in_sample"] * 5 + ["out_sample"]
    for number, (_, k, error, signed, sales, days) in enumerate(scores):
        a, b = 28 * (number + 1), 28 * (number + 2)
        rows = [i for i in range(a, b) if frame["y"][i] > 0]
        misses = [math.expm1(min(max(float(x[i] @ path[a - 1]), 0.0), 30.0)) - frame["y"][i] for i in rows]
        assert (k, days) == (number, len(rows)) and math.isclose(sales, sum(frame["y"][i] for i in rows))
        assert math.isclose(error, sum(map(abs, misses))) and math.isclose(signed, sum(misses))


def test_priors_weights_and_horizon_lists():
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(40), rng.uniform(1, 2, (40, 2))])
    y = x @ [2.0, 1.0, -0.5] + 3
    priors = [Prior(constant=True), Prior(0.5, 0.3, relative=True), Prior(-0.25, 0.1)]
    coef, spread = start(priors, x[:28], y[:28])
    mean = y[:28].mean()
    assert np.allclose(coef[1:], [0.5 / mean, -0.25]) and np.allclose(spread[1:], [(0.3 / mean / 0.2) ** 2, 0.25])
    rest = (y[:28] - x[:28, 1:] @ coef[1:]).mean()
    assert math.isclose(coef[0], rest) and math.isclose(spread[0], (0.5 * rest / 0.2) ** 2)
    assert np.allclose(start([Prior(constant=True), Prior(1e9, relative=True)], x[:28, :2], y[:28])[0][1], 1e6)
    for bad in ([Prior(), Prior(), Prior()], priors[:2]):
        with pytest.raises(ValueError):
            start(bad, x, y)
    model = R.RecursiveLeastSquares(0.99, priors=priors, weighting=R.log_weighting).fit(x, y)
    plain = R.coefficient_path(x, y, 0.99, 0.0, 28, weights=np.asarray([math.sqrt(math.exp(v) / v) for v in y]), begin=(coef, spread))
    assert np.allclose(model.path, plain)
    lists = model.forecasts(x, horizon=12)
    assert [len(f) for f in lists] == [0] * 3 + [12] * 26 + list(range(11, 0, -1))
    assert all(np.allclose(f, [x[i + k] @ model.path[i] for k in range(len(f))]) for i, f in enumerate(lists))
    assert [len(f) for f in R.behind(x, model.path, 5)] == [0] * 5 + list(range(5, 40))
    with pytest.raises(ValueError):
        R.RecursiveLeastSquares(priors=[Prior()])


def test_date_helpers():
    monday = dt.date(2024, 5, 6)
    for k in range(7):
        day = monday + dt.timedelta(days=k)
        assert D.sunday_before(day) == (day if k == 6 else dt.date(2024, 5, 5)) and D.sunday_after(day) == dt.date(2024, 5, 12)
        assert D.monday_after(day) == (day if k == 0 else dt.date(2024, 5, 13))
    assert D.train_window(dt.date(2024, 5, 7), dt.date(2024, 7, 31)) == (dt.date(2024, 5, 13), dt.date(2024, 7, 7))
    assert D.train_window(dt.date(2024, 5, 7), dt.date(2024, 5, 20)) == (dt.date(2024, 5, 13), dt.date(2024, 5, 20))
    assert D.block_start(monday, dt.date(2024, 5, 8)) == dt.date(2024, 6, 3) and D.block_start(monday, monday) == monday
    with pytest.raises(ValueError):
        D.train_window(monday, monday, 0)


def test_holiday_windows():
    columns = K.offset_columns()
    assert len(columns) == 78 and "xmas_m3" in columns and "carnaval_p0" not in columns and not any(n in K.RAMPS for n, _ in columns.values())
    assert K.holiday_date(K.HOLIDAYS["black_friday"].rule, 2024) == dt.date(2024, 11, 22)
    assert K.holiday_date(K.HOLIDAYS["carnaval"].rule, 2024) == dt.date(2024, 2, 12)
