"""Diagnostics over leaf forecasts with traces: residuals and what they point to, and the strength of the parents' effect."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Residual, Strength
from tidemark.functions.exprs import clip, count_if, is_finite, median_if, ratio, ratio_or_zero, sum_if
from tidemark.operators.ranking import best_per_key

LEAF = ["section", "store", "sku"]
DIMENSIONS = ("store", "ds", "weekday", "month", "parent_model")


def long_targets(forecast: DataFrame) -> DataFrame:
    """Known leaf days, a row a target, by one stack: actual, forecast, level, first level, effect, parent."""
    fields = {"actual": ("y", "value"), "forecast": ("yhat", "valuehat"), "level": ("ses_level_y", "ses_level_value"), "initial": ("initial_level_y", "initial_level_value"), "effect": ("driver_effect_y", "driver_effect_value"), "parent_model": ("parent_model_y", "parent_model_value")}
    sides = ", ".join(f"'{t}', " + ", ".join(pair[i] for pair in fields.values()) for i, t in enumerate(("units", "value")))
    known = forecast.where("period_type <> 'forecast_only'")
    return known.select(*LEAF, "ds", "period_type", "rls_block", "rls_metric_eligible", F.col("y").alias("units"), F.expr(f"stack(2, {sides}) AS (target, {', '.join(fields)})"))


def scored_residuals(forecast: DataFrame, rule: Residual = Residual()) -> DataFrame:
    """Errors of each leaf day on the leaf's causal scale, the effect that would have been needed, and whether the day is extreme."""
    rows = long_targets(forecast).where(is_finite(F.col("actual")) & is_finite(F.col("forecast")))
    zero = F.lit(0.0)
    scale = F.greatest(F.abs(F.coalesce("level", zero)), F.abs(F.coalesce("initial", zero)), F.lit(1.0))
    floor = F.greatest(scale * rule.floor_share, F.lit(1e-9))
    actual, predicted = F.greatest("actual", zero), F.greatest("forecast", zero)
    error = F.abs(F.col("forecast") - F.col("actual"))
    rows = rows.withColumns({
        "error": F.col("forecast") - F.col("actual"), "abs_error": error, "scaled_gap": error / scale,
        "factor_gap": (F.greatest(actual, predicted) + floor) / (F.least(actual, predicted) + floor),
        "official": is_finite(F.col("units")) & (F.col("units") > 0), "zero_sale": F.col("units").isNull() | (F.col("units") <= 0),
        "unexplained": F.log1p(actual) - F.log1p(F.greatest(F.coalesce("level", zero), zero)) - F.coalesce("effect", zero),
        "gain": F.abs(F.col("actual") - F.coalesce("level", zero)) - error,
        "under": F.col("forecast") < F.col("actual"), "weekday": F.weekday("ds") + 1, "month": F.month("ds"),
    })
    extreme = ((F.col("factor_gap") >= rule.factor) & (F.col("scaled_gap") >= rule.material)) | (F.col("scaled_gap") >= rule.severe)
    return rows.withColumn("extreme", extreme)


def residual_summary(scored: DataFrame) -> DataFrame:
    """Per store, target and period: errors, extremes and days without sales, and whether drivers or missing sales deserve a review."""
    x, official, zero = F.col("extreme"), F.col("official"), F.col("zero_sale")
    error = F.col("abs_error")
    out = scored.groupBy("section", "store", "target", "period_type").agg(
        F.count(F.lit(1)).alias("n_points"), count_if(official).alias("n_official"), count_if(zero).alias("n_zero_sale"), count_if(x).alias("n_extreme"),
        count_if(x & zero).alias("n_zero_sale_extreme"), count_if(x & official).alias("n_official_extreme"),
        F.sum("abs_error").alias("abs_error"), F.sum(F.abs("actual")).alias("abs_actual"), sum_if(zero, error).alias("zero_sale_error"),
        sum_if(official, error).alias("official_error"), sum_if(official, F.abs("actual")).alias("official_actual"), sum_if(x & official, error).alias("extreme_error"),
        median_if(x, F.col("scaled_gap")).alias("median_scaled_gap"), median_if(x, F.col("factor_gap")).alias("median_factor_gap"),
        median_if(x & official, F.abs("unexplained")).alias("median_unexplained"), median_if(x, F.col("gain")).alias("median_gain"),
        F.avg(F.when(x, (F.col("gain") > 0).cast("double"))).alias("help_share"), F.avg(F.when(x, F.col("under").cast("double"))).alias("under_share"),
    )
    out = out.withColumns({
        "wmape_all_points": ratio(F.col("abs_error"), F.col("abs_actual")), "wmape": ratio(F.col("official_error"), F.col("official_actual")),
        "zero_sale_share": ratio_or_zero(F.col("zero_sale_error"), F.col("abs_error")), "extreme_share": ratio_or_zero(F.col("extreme_error"), F.col("official_error")),
        "extreme_point_share": ratio_or_zero(F.col("n_extreme").cast("double"), F.col("n_points").cast("double")),
    })

    def graded(count, share, *more):
        strong, moderate = (F.col(count) >= 3) & (F.col(share) >= 0.5), (F.col(count) >= 2) & (F.col(share) >= 0.25)
        for column, (a, b) in more:
            strong, moderate = strong & (F.col(column) >= a), moderate & (F.col(column) >= b)
        return F.when(strong, "strong").when(moderate, "moderate").otherwise("low")

    return out.withColumns({
        "driver_review": graded("n_official_extreme", "extreme_share", ("median_unexplained", (math.log(2.0), math.log(1.5)))),
        "zero_sale_review": graded("n_zero_sale_extreme", "zero_sale_share"),
    })


def residual_signals(scored: DataFrame) -> DataFrame:
    """Extreme days by store, date, weekday, month and parent, in one pass: each value's part of its target's extreme error."""
    values = ", ".join(f"'{d}', CAST({d} AS STRING)" for d in DIMENSIONS)
    rows = scored.where("extreme").select("*", F.expr(f"stack({len(DIMENSIONS)}, {values}) AS (dimension, dimension_value)"))
    keys = ["section", "target", "period_type", "dimension"]
    out = rows.groupBy(*keys, "dimension_value").agg(
        F.count(F.lit(1)).alias("n_extreme"), F.count_distinct(*LEAF).alias("n_leaves"), sum_if(F.col("official"), F.col("abs_error")).alias("extreme_error"), F.sum("error").alias("signed_error"),
        F.median("scaled_gap").alias("median_scaled_gap"), F.median(F.abs("unexplained")).alias("median_unexplained"),
        F.avg(F.col("zero_sale").cast("double")).alias("zero_sale_share"), F.avg((F.col("gain") > 0).cast("double")).alias("help_share"), F.avg(F.col("under").cast("double")).alias("under_share"),
    )
    return out.withColumn("error_share", ratio_or_zero(F.col("extreme_error"), F.sum("extreme_error").over(Window.partitionBy(*keys))))


def strength_folds(forecast: DataFrame, strengths=Strength().grid) -> DataFrame:
    """Error of log1p(level) + strength * effect, by section, target, parent, period, block and strength; strength 1 is what was issued."""
    rows = long_targets(forecast.where("rls_metric_eligible")).where(is_finite(F.col("units")) & (F.col("units") > 0) & is_finite(F.col("actual")) & is_finite(F.col("level")) & is_finite(F.col("effect")))
    rows = rows.withColumn("strength", F.explode(F.array(*map(F.lit, strengths))))
    raw = F.greatest(F.exp(clip(F.log1p(F.greatest("level", F.lit(0.0))) + F.col("strength") * F.col("effect"), -50.0, 50.0)) - 1, F.lit(0.0))
    error = F.when(F.col("target") == "units", F.bround(raw, 0)).otherwise(F.bround(raw, 2)) - F.col("actual")
    keys = ["section", "target", "parent_model", "period_type", "rls_block"]
    folds = rows.groupBy(*keys, "strength").agg(F.sum(F.abs(error)).alias("abs_error"), F.sum(error).alias("signed_error"), F.sum(F.abs("actual")).alias("abs_y"), F.count(F.lit(1)).alias("n_points"))
    folds = folds.withColumn("wmape", ratio(F.col("abs_error"), F.col("abs_y")))
    base = F.max(F.when(F.col("strength") == 1.0, F.col("wmape"))).over(Window.partitionBy(*keys))
    return folds.withColumn("improvement", base - F.col("wmape")).withColumn("no_worse", F.col("wmape") <= base + 1e-15)


def strength_summary(folds: DataFrame) -> DataFrame:
    out = folds.groupBy("section", "target", "parent_model", "period_type", "strength").agg(
        F.sum("abs_error").alias("abs_error"), F.sum("signed_error").alias("signed_error"), F.sum("abs_y").alias("abs_y"), F.sum("n_points").alias("n_points"), F.count(F.lit(1)).alias("n_folds"),
        F.median("wmape").alias("median_fold_wmape"), F.max("wmape").alias("worst_fold_wmape"), F.avg(F.col("no_worse").cast("double")).alias("positive_share"), F.median("improvement").alias("median_improvement"),
    )
    return out.withColumn("wmape", ratio(F.col("abs_error"), F.col("abs_y"))).withColumn("bias", ratio(F.col("signed_error"), F.col("abs_y")))


def strength_recommendation(summary: DataFrame, rule: Strength = Strength()) -> DataFrame:
    """The strength that history favours; the holdout can confirm or veto it, never propose one."""
    keys = ["section", "target", "parent_model"]
    history = summary.where("period_type = 'in_sample'")
    best = best_per_key(history, keys, F.asc_nulls_last("wmape"), F.asc_nulls_last("worst_fold_wmape"), F.asc(F.abs(F.col("strength") - 1.0)), F.asc("strength"))
    best = best.select(*keys, "strength", F.col("wmape").alias("history_wmape"), F.col("bias").alias("history_bias"), F.col("positive_share").alias("history_positive_share"), "n_folds")
    holdout = summary.where("period_type = 'out_sample'")
    issued = [df.where("strength = 1.0").select(*keys, F.col("wmape").alias(f"issued_{n}_wmape"), F.col("bias").alias(f"issued_{n}_bias")) for n, df in (("history", history), ("holdout", holdout))]
    out = best.join(issued[0], keys, "left").join(holdout.select(*keys, "strength", F.col("wmape").alias("holdout_wmape"), F.col("bias").alias("holdout_bias")), [*keys, "strength"], "left").join(issued[1], keys, "left")
    out = out.withColumns({
        "history_improvement": F.col("issued_history_wmape") - F.col("history_wmape"), "holdout_improvement": F.col("issued_holdout_wmape") - F.col("holdout_wmape"),
        "bias_change": F.abs("holdout_bias") - F.abs("issued_holdout_bias"),
    })
    wanted = (F.abs(F.col("strength") - 1.0) > 1e-12) & (F.col("n_folds") >= rule.min_folds) & (F.col("history_improvement") >= rule.margin) & (F.col("history_positive_share") >= rule.most)
    status = (
        F.when(~F.coalesce(wanted, F.lit(False)), "keep_current")
        .when(F.col("holdout_wmape").isNull(), "no_holdout")
        .when((F.col("holdout_improvement") >= 0) & (F.col("bias_change") <= rule.margin), "validated_calibration")
        .when((F.col("holdout_improvement") < 0) | (F.col("bias_change") > 2 * rule.margin), "vetoed_by_holdout")
        .otherwise("mixed_holdout")
    )
    return out.withColumn("status", status)
