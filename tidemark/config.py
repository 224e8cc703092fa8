"""Settings as frozen values, passed as arguments."""

from dataclasses import dataclass

CADENCES = (1, 7, 14, 28)


@dataclass(frozen=True)
class Horizon:
    oos_days: int = 28
    forecast_days: int = 28
    block_days: int = 28


@dataclass(frozen=True)
class Cohorts:
    active_days: int = 7
    ranking_days: int = 15


@dataclass(frozen=True)
class Price:
    window: int = 16


@dataclass(frozen=True)
class Discrepancy:
    factor: float = 3.0
    scale: float = 3.0


@dataclass(frozen=True)
class Rls:
    decays: tuple[float, ...] = (0.970, 0.985, 0.995)
    modes: tuple[str, ...] = ("ar", "base")
    default: tuple[str, float] = ("base", 0.995)
    min_y_units: float = 1.0
    min_y_value: float = 1e-8
    seed_days: int = 28
    prior_scale: float = 0.5


@dataclass(frozen=True)
class Ses:
    """Guards of the leaf recursion; fixed values of the domain."""

    alphas: tuple[float, ...] = (0.01, 0.025, 0.05, 0.075, 0.10, 0.15, 0.20, 0.30, 0.50, 0.80)
    default_alpha: float = 0.10
    warmup_days: int = 28
    dormant_gap: int = 28
    dormant_factor: float = 1e-12
    decay: float = 0.975
    decay_cap: int = 84
    decay_floor: float = 0.10
    max_multiple: float = 2.0
    mean_multiple: float = 4.0
    gap_mean_multiple: float = 2.0
    clip_low: float = 0.5
    clip_high: float = 2.0
    anchor_clamp: float = 1.5
    anchor_points: int = 7
    envelope: tuple[float, float] = (0.75, 1.25)
    reactivation_alpha: float = 0.20


@dataclass(frozen=True)
class Residual:
    """When a leaf day's error is extreme: forecast and actual a factor apart and materially so, or the gap severe, on the leaf's scale."""

    factor: float = 4.0
    material: float = 0.15
    severe: float = 3.0
    floor_share: float = 0.05


@dataclass(frozen=True)
class Strength:
    grid: tuple[float, ...] = (0.0, 0.25, 0.50, 0.75, 0.90, 1.0, 1.10, 1.25, 1.50)
    min_folds: int = 4
    margin: float = 0.005
    most: float = 0.60


@dataclass(frozen=True)
class Effect:
    lookback: int = 28
    min_points: int = 7
    regime_ratio: float = 1.5
    low: float = 0.5
    high: float = 2.0
