"""Validators and release gates: each is one aggregate over the forecast."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import clip, count_if, is_finite, median_if, ratio
from tidemark.operators.metrics import PARTS, leaf_parts, with_ratios

LEAF = ["section", "store", "sku"]


def structural(forecast: DataFrame, horizon: int = 28, low: float = 0.5, high: float = 2.0, tolerance: float = 1e-7) -> DataFrame:
    """check, violations: rules of a leaf forecast with traces (0 everywhere if it is sound), rows and leaves each in one aggregate."""
    periods = ("in_sample", "out_sample", "forecast_only")
    warm = F.col("ds") <= F.col("leaf_warmup_end")
    eligible = F.coalesce("rls_metric_eligible", F.lit(False))
    rows = {
        "period outside the three": ~F.col("period_type").isin(*periods),
        "warm-up is eligible": warm & eligible,
        "forecast-only is eligible": (F.col("period_type") == "forecast_only") & eligible,
        "observable day index below 0": F.col("leaf_observable_day_index") < 0,
    }
    for t, hat, digits in (("y", "yhat", 0), ("value", "valuehat", 2)):
        raw, cap, effect = F.col(f"{hat}_raw"), F.col(f"leaf_forecast_cap_{t}"), F.col(f"driver_effect_{t}")
        plain = F.greatest(F.expm1(F.log1p(F.greatest(f"ses_level_{t}", F.lit(0.0))) + effect), F.lit(0.0))
        built = F.when(cap > 0, F.least(plain, cap)).otherwise(plain)
        expected = clip(F.col(f"driver_raw_{t}") - F.col(f"driver_reference_{t}") - F.col(f"driver_center_{t}"), math.log(low), math.log(high))

        def off(a, b):
            return F.abs(a - b) > tolerance * (1 + F.abs(b))

        rows |= {
            f"{hat} is not finite": ~is_finite(raw),
            f"{hat} below 0": raw < 0,
            f"{hat} is not level and effect": (cap > 0) & off(raw, built),
            f"{hat} is not its rounded value": F.abs(F.col(hat) - F.bround(raw, digits)) > 1e-6 + 1e-12 * F.abs(raw),
            f"cap of {t} below 0": cap < 0,
            f"{hat} above its cap": (cap > 0) & (raw > cap + tolerance * (1 + cap)),
            f"gap of {t} below 0": F.col(f"leaf_gap_observable_days_{t}") < 0,
            f"gap factor of {t} outside (0, 1]": (F.col(f"leaf_gap_decay_factor_{t}") <= 0) | (F.col(f"leaf_gap_decay_factor_{t}") > 1 + tolerance),
            f"parent of {t} is neither store nor section": ~F.col(f"parent_model_{t}").isin("store", "section"),
            f"warm-up effect of {t} is not 0": warm & (effect != 0),
            f"warm-up factor of {t} is not 1": warm & (F.col(f"driver_factor_{t}") != 1),
            f"factor of {t} is not exp(effect)": off(F.col(f"driver_factor_{t}"), F.exp(effect)),
            f"factor of {t} outside its guard": ~F.col(f"driver_factor_{t}").between(low - tolerance, high + tolerance),
            f"effect of {t} is not raw less reference less centre": ~warm & (F.col(f"driver_reference_level_{t}") > 0) & off(effect, expected),
            f"raw effect of {t} is not the parent's forecast": ~warm & off(F.col(f"driver_raw_{t}"), F.log1p(F.greatest(f"driver_parent_forecast_{t}", F.lit(0.0)))),
            f"reference of {t} is not the parent's level": ~warm & off(F.col(f"driver_reference_{t}"), F.log1p(f"driver_reference_level_{t}")),
        }
    leaves = forecast.groupBy(*LEAF).agg(
        *(F.count_distinct(F.when(F.col("period_type") == p, F.col("ds"))).alias(p) for p in periods),
        F.max(F.when(F.col("period_type") == "out_sample", F.col("ds"))).alias("oos_end"), F.min(F.when(F.col("period_type") == "forecast_only", F.col("ds"))).alias("start"),
        F.count(F.lit(1)).alias("n"), F.count_distinct("ds").alias("n_days"),
    )
    whole = {
        "holdout has not its days": F.col("out_sample") != horizon,
        "horizon has not its days": F.col("forecast_only") != horizon,
        "no history": F.col("in_sample") == 0,
        "horizon does not follow the holdout": F.date_diff("start", "oos_end") != 1,
        "a day stands twice": F.col("n") != F.col("n_days"),
    }

    def counted(df, checks):
        sums = df.agg(*(count_if(c).alias(f"v{i}") for i, c in enumerate(checks.values())))
        each = F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.coalesce(f"v{i}", F.lit(0)).cast("long").alias("violations")) for i, n in enumerate(checks))))
        return sums.select(each.alias("c")).select("c.*")

    return counted(forecast, rows).union(counted(leaves, whole))


def adjacency(windows: DataFrame) -> DataFrame:
    """Sections whose forecast does not begin on the day after the out-of-sample window, or whose windows have wrong lengths."""
    bad = (F.date_diff("forecast_start", "oos_end") != 1) | (F.date_diff("oos_end", "oos_start") != 27) | (F.date_diff("forecast_end", "forecast_start") != 27)
    return windows.where(bad)


def spike_gate(fc: DataFrame, max_ratio: float = 8.0, median_ratio: float = 2.0) -> DataFrame:
    """Out-of-sample forecasts against the history of their leaf: median and maximum ratios."""
    history = fc.where("k > 0").groupBy(*LEAF).agg(median_if(F.col("y") > 0, F.col("y")).alias("history_median"), F.max("y").alias("history_max"))
    oos = fc.where("k = 0").groupBy(*LEAF).agg(F.median("yhat").alias("forecast_median"), F.max("yhat").alias("forecast_max"))
    out = oos.join(history, LEAF).withColumn("median_ratio", ratio(F.col("forecast_median"), F.col("history_median"))).withColumn("max_ratio", ratio(F.col("forecast_max"), F.col("history_median")))
    return out.withColumn("spike", F.coalesce((F.col("max_ratio") > max_ratio) & (F.col("median_ratio") > median_ratio), F.lit(False)))


def cadence_summary(forecast: DataFrame, cadence: int) -> DataFrame:
    """Per leaf and target of one cadence: days with sales in the holdout, and medians of actuals and forecasts on them."""
    oos = forecast.where((F.col("period_type") == "out_sample") & (F.col("y") > 0))
    long = oos.select(*LEAF, F.expr("stack(2, 'units', y, yhat_raw, 'value', value, valuehat_raw) AS (target, actual, forecast)"))
    return long.groupBy(*LEAF, "target").agg(F.count(F.lit(1)).alias("n_positive"), F.median("actual").alias("actual_median"), F.median("forecast").alias("forecast_median")).withColumn("cadence", F.lit(cadence))


def long_gaps(forecast: DataFrame, cadence: int, least: int = 28) -> DataFrame:
    """Leaf, target and cadence keys that come back in the holdout after a long observable gap; another gate judges those."""
    oos = forecast.where("period_type = 'out_sample'")
    long = oos.select(*LEAF, F.expr("stack(2, 'units', leaf_gap_observable_days_y, 'value', leaf_gap_observable_days_value) AS (target, gap)"))
    return long.where(F.col("gap") >= least).select(*LEAF, "target").distinct().withColumn("cadence", F.lit(cadence))


def cadence_gate(totals: DataFrame, max_ratio: float = 4.0, max_gap: float = 2.0, skip: DataFrame | None = None, active_days: int = 7) -> DataFrame:
    """Leaves and targets whose forecasts disagree between cadences, from summaries of all cadences; `skip`: keys out of this gate."""
    rows = totals.join(skip, [*LEAF, "target", "cadence"], "left_anti") if skip is not None else totals
    active = rows.where((F.col("n_positive") >= active_days) & is_finite(F.col("forecast_median")) & (F.col("forecast_median") > 0))
    out = active.groupBy(*LEAF, "target").agg(F.min("forecast_median").alias("low"), F.max("forecast_median").alias("high"), F.median("actual_median").alias("scale"), F.count_distinct("cadence").alias("n_cadences"))
    apart = ratio(F.col("high"), F.col("low"))
    gap = ratio(F.col("high") - F.col("low"), F.col("scale"))
    return out.withColumn("ratio", apart).withColumn("scaled_gap", gap).withColumn("incoherent", F.coalesce((apart > max_ratio) & (gap > max_gap), F.lit(False)))


def window_identity(forecasts: DataFrame) -> DataFrame:
    """Training windows of each section in the forecasts of all cadences (n_windows of 1 is right)."""
    windows = forecasts.where("period_type = 'in_sample'").groupBy("section", "cadence").agg(F.min("ds").alias("train_start"), F.max("ds").alias("train_end"))
    return windows.groupBy("section").agg(F.min("train_start").alias("train_start"), F.max("train_end").alias("train_end"), F.count_distinct("train_start", "train_end").alias("n_windows"), F.count(F.lit(1)).alias("n_cadences"))


def reactivation_gate(days: DataFrame, min_gap: int = 84) -> DataFrame:
    """Sales after a long gap, with the sale before it."""
    w = Window.partitionBy(*LEAF).orderBy("ds")
    rows = days.where(F.col("y") > 0).withColumn("previous_ds", F.lag("ds").over(w)).withColumn("previous_y", F.lag("y").over(w))
    return rows.withColumn("gap", F.date_diff("ds", "previous_ds").cast("long")).where(F.col("gap") >= min_gap).select(*LEAF, "ds", "y", "previous_ds", "previous_y", "gap")


def identity_audit(fc: DataFrame, stored: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Stored metrics of sections, stores and SKUs against sums straight from the forecast's rows: a row a node, with its worst relative difference and whether it may pass."""
    level = {"section": ["section"], "store": ["section", "store"], "sku": ["section", "sku"]}
    out = None
    for name, keys in level.items():
        rebuilt = leaf_parts(fc, [*keys, "period_type"]).select(*keys, "period_type", *(F.col(p).alias(f"r_{p}") for p in PARTS))
        joined = rebuilt.join(stored.where(F.col("level") == name).select(*keys, "period_type", *PARTS), [*keys, "period_type"], "full")
        gaps = [F.coalesce(F.abs(F.col(f"r_{p}") - F.col(p)) / F.greatest(F.abs(F.col(f"r_{p}")), F.lit(1.0)), F.lit(float("inf"))) for p in PARTS]
        rows = joined.select(F.lit(name).alias("level"), "section", *(F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in ("store", "sku")), "period_type", F.col("r_sum_y").alias("sum_y"), F.col("r_sum_abs_error").alias("sum_abs_error"), F.greatest(*gaps).alias("worst"))
        out = rows if out is None else out.union(rows)
    return out.withColumn("ok", F.col("worst") <= tolerance)


def sample_audit(fc: DataFrame, stored: DataFrame, per_unit: int = 12, tolerance: float = 1e-9) -> DataFrame:
    """The first leaves by id, each unit: their holdout metrics computed again from the forecast's rows, next to the stored ones. A sampling operator, so it has a limit.

    `stored`: metrics with `unidad`; `fc`: the forecast with y, yhat, value, valuehat."""
    leaves = stored.where((F.col("level") == "leaf") & (F.col("period_type") == "out_sample"))
    first = Window.partitionBy("unidad").orderBy(*LEAF)
    chosen = leaves.withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_unit).drop("place")
    rows = fc.where("period_type = 'out_sample'").join(chosen.select(*LEAF).distinct(), LEAF, "left_semi")
    long = rows.select(*LEAF, "period_type", F.expr("stack(2, 'units', y, yhat, 'value', value, valuehat) AS (unidad, y, yhat)"))
    again = with_ratios(leaf_parts(long, [*LEAF, "unidad", "period_type"]))
    figures = ("wmape", "bias", "wmape_all_points", "bias_all_points", "sum_abs_y", "sum_abs_error", "sum_signed_error")
    joined = chosen.select(*LEAF, "unidad", *figures).join(again.select(*LEAF, "unidad", *(F.col(n).alias(f"again_{n}") for n in figures)), [*LEAF, "unidad"], "left")

    def off(n):
        a, b = F.col(n), F.col(f"again_{n}")
        return F.when(a.isNull() & b.isNull(), 0.0).otherwise(F.coalesce(F.abs(a - b) / F.greatest(F.abs(b), F.lit(1.0)), F.lit(float("inf"))))

    return joined.select(*LEAF, "unidad", F.greatest(*map(off, figures)).alias("worst")).withColumn("ok", F.col("worst") <= tolerance)


def sentinel(fc: DataFrame, section: str, store: str) -> DataFrame:
    return leaf_parts(fc.where((F.col("section") == section) & (F.col("store") == store)), ["section", "store", "period_type"])


def acceptance(fc: DataFrame) -> DataFrame:
    """Overall sizes and accuracy for a release note."""
    parts = leaf_parts(fc, ["period_type"])
    return parts.withColumn("wmape", ratio(F.col("sum_abs_error"), F.col("sum_abs_y")))


def config_errors(horizon, ses, effect, rls) -> list[str]:
    """Rules of the configuration that are broken; empty if it may be released."""
    rules = {
        "holdout and horizon have 28 days": horizon.oos_days == 28 and horizon.forecast_days == 28,
        "seed covers a block": rls.seed_days >= 28 and horizon.block_days <= rls.seed_days,
        "decays lie in (0, 1]": all(0 < d <= 1 for d in rls.decays) and rls.default[1] in rls.decays and rls.default[0] in rls.modes,
        "smoothing weights lie in (0, 1)": all(0 < a < 1 for a in ses.alphas) and ses.default_alpha in ses.alphas,
        "effect bounds hold 1": 0 < effect.low < 1 < effect.high,
        "envelope holds 1": ses.envelope[0] < 1 < ses.envelope[1],
        "caps exceed the mean": ses.gap_mean_multiple <= ses.mean_multiple and ses.max_multiple >= 1,
    }
    return [name for name, ok in rules.items() if not ok]
