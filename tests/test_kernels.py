"""Kernels against plain re-statements and hand-checked scenarios."""

import datetime as dt

import numpy as np
import pytest

from tidemark.functions import effect as E
from tidemark.functions import rls as R
from tidemark.functions import ses as S
from tidemark.operators import calendar as K


def plain_rls(x, y, decay, min_y, seed):
    coef = np.zeros(x.shape[1])
    coef[0] = y[:seed].mean()
    b = np.diag([0.5 * coef[0], *[0.5] * (x.shape[1] - 1)])
    out = []
    for row, target in zip(x, y):
        if target > min_y:
            k = b @ row / (decay + row @ b @ row)
            coef = coef + k * (target - row @ coef)
            b = (b - np.outer(k, row @ b)) / decay
        out.append(coef)
    return np.asarray(out)


def test_rls_path_equals_a_plain_recursion():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(84), rng.normal(size=(84, 3))])
    y = np.abs(x @ [3, 1, -1, 0.5] + rng.normal(size=84) * 0.1)
    y[10] = 0.0
    assert np.allclose(R.coefficient_path(x, y, 0.985, 0.0, 28), plain_rls(x, y, 0.985, 0.0, 28))


def test_rls_sees_no_later_row():
    x = np.column_stack([np.ones(84), np.linspace(0, 1, 84)])
    y = 5 + 2 * x[:, 1]
    changed = y.copy()
    changed[28:] *= 3
    a, b = (R.RecursiveLeastSquares(0.99).fit(x, z).path for z in (y, changed))
    assert np.array_equal(a[27], b[27]) and not np.allclose(a[27], a[55]) and not np.allclose(a[40], b[40])


def test_rls_rejects_bad_input():
    x, y = np.ones((3, 1)), np.ones(3)
    for bad in (np.nan, np.inf):
        with pytest.raises(ValueError):
            R.RecursiveLeastSquares().fit(np.full((3, 1), bad), y)
    with pytest.raises(ValueError):
        R.RecursiveLeastSquares(decay=1.1)
    with pytest.raises(ValueError):
        R.RecursiveLeastSquares(constant_priors=2)
    with pytest.raises(NotImplementedError):
        R.RecursiveLeastSquares(metrics=True)
    with pytest.raises(ValueError):
        R.RecursiveLeastSquares().predict(x)


def test_ar_forecast_feeds_itself():
    x, coef = np.ones((9, 1)), np.asarray([1.0, 0.5, 0, 0, 0])
    z = np.log1p(R.predict_log_ar(x, coef, np.full(28, 2.0)))
    assert np.allclose(z[:7], 2.0) and np.allclose(z[7:], 1 + 0.5 * z[:2])


def test_parent_effect_scenarios():
    n = 60
    forecast = np.full(n, 100.0)
    forecast[35] = 100_000
    out = E.relative_effect(np.full(n, 100.0), forecast, np.arange(n))
    assert np.isclose(np.exp(out["effect"][35]), 2.0) and out["reference"][35] == 100
    actual = np.where(np.arange(84) < 28, 100.0, 1000.0)
    out = E.relative_effect(actual, np.full(84, 100.0), np.arange(84) // 28)
    assert (out["reference"][28:56] == 100).all() and (out["reference"][56:] == 1000).all()
    forecast = np.full(84, 100.0)
    forecast[56:70] = 220
    out = E.relative_effect(np.full(84, 100.0), forecast, np.arange(84) // 14)
    assert np.abs(out["effect"][56:70]).max() < 1e-12 and (out["centre"][56:70] > 0).all()


def walk(y, index=None, oos=None, alphas=(0.1,), init=10.0, gap_aware=False, **kw):
    n = len(y)
    index = np.arange(1, n + 1) if index is None else np.asarray(index)
    period = np.where(np.arange(n) >= (n if oos is None else oos), S.HOLDOUT, S.HISTORY)
    return S.walk_forward(np.asarray(y, float), index, np.arange(n), period, np.zeros(n), init, np.zeros(n, bool), alphas=alphas, gap_aware=gap_aware, **kw)


def test_ses_spike_and_caps():
    out = walk([10] * 8 + [1000, 10, 10], oos=9, alphas=(0.8,))
    assert out["forecast"][9] <= 20 and out["level"][9] <= 20
    out = walk([10] * 10, oos=8, alphas=(0.005,), init=100)
    assert out["cap"][8] == 20 and out["forecast"][8] <= 20
    assert walk([1] * 9 + [20, 0], alphas=(0.01,), init=30)["cap"][-1] <= 4 * 2.9
    out = walk([2, 2, 2, 0], index=[1, 2, 3, 100])
    assert out["cap"][-1] <= 4 and out["level"][-1] > 0


def test_ses_gaps_and_reactivation():
    out = walk([10, 10], index=[1, 701])
    assert out["level"][1] == 10 and out["factor"][1] == 1 and out["gap"][1] >= 699
    out = walk([100, 10, 10], index=[1, 62, 63], init=100)
    assert out["forecast"][1] >= 99 and out["level"][2] <= 20
    out = walk([10, 10, 10], index=[1, 2, 40], gap_aware=True)
    assert out["factor"][2] == 1e-12 and out["forecast"][2] < 1e-6
    assert np.isclose(walk([10, 10], index=[1, 12], gap_aware=True)["factor"][1], 0.975**10)


def test_ses_holdout_rules():
    assert walk([10] * 8 + [100, 100, 0], oos=8, alphas=(0.8,))["level"][-1] <= 12.5 + 1e-9
    out = walk([10] * 8 + [20, 20], oos=8)
    assert out["level"][8] == 10 and out["level"][9] > 10
    out = walk([10, 12, 9, 11, 10, 10, 30, 5, 40, 2, 60, 1], oos=6, alphas=(0.05, 0.8))
    assert len(set(out["alpha"][6:])) == 1


def test_later_sales_leave_earlier_forecasts_alone():
    y = np.asarray([10, 12, 9, 11, 10, 10, 30, 5.0])
    other = y.copy()
    other[5:] = 500
    a, b = walk(y, oos=6, alphas=(0.05, 0.3)), walk(other, oos=6, alphas=(0.05, 0.3))
    assert np.array_equal(a["forecast"][:6], b["forecast"][:6])


def test_calendar_rules():
    assert [K.easter(y) for y in (2000, 2024, 2025)] == [dt.date(2000, 4, 23), dt.date(2024, 3, 31), dt.date(2025, 4, 20)]
    assert K.holiday_date(("nth", 5, 7, 2), 2024) == dt.date(2024, 5, 12)
    with pytest.raises(ValueError):
        K.holiday_date(("lunar", 1), 2024)
