"""Bottom-up accuracy: wMAPE and bias over official (y not 0) and all points, cohorts and scopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Cohorts
from tidemark.functions.exprs import cohort, is_finite, ratio, ratio_or_zero, sum_if, unique_id
from tidemark.operators.rollup import level_sets

PARTS = ["sum_y", "sum_yhat", "sum_abs_y", "sum_abs_error", "sum_signed_error", "all_abs_y", "all_abs_error", "all_signed_error", "n_points", "n_with_sales"]


def leaf_parts(fc: DataFrame, keys: list[str]) -> DataFrame:
    """Additive parts of all metrics in one pass; rows with a non-finite y or yhat count nowhere."""
    y, yhat = F.col("y"), F.col("yhat")
    rows = fc.where(is_finite(y) & is_finite(yhat) & (F.col("period_type") != "forecast_only"))
    sale, error = y != 0, yhat - y
    return rows.groupBy(*keys).agg(
        sum_if(sale, y).alias("sum_y"), sum_if(sale, yhat).alias("sum_yhat"), sum_if(sale, F.abs(y)).alias("sum_abs_y"),
        sum_if(sale, F.abs(error)).alias("sum_abs_error"), sum_if(sale, error).alias("sum_signed_error"),
        F.sum(F.abs(y)).alias("all_abs_y"), F.sum(F.abs(error)).alias("all_abs_error"), F.sum(error).alias("all_signed_error"),
        F.count(F.lit(1)).alias("n_points"), F.count(F.when(sale, 1)).alias("n_with_sales"),
    )


def with_ratios(parts: DataFrame) -> DataFrame:
    return (
        parts.withColumn("wmape", ratio(F.col("sum_abs_error"), F.col("sum_abs_y")))
        .withColumn("bias", ratio(F.col("sum_signed_error"), F.col("sum_abs_y")))
        .withColumn("wmape_all_points", ratio(F.col("all_abs_error"), F.col("all_abs_y")))
        .withColumn("bias_all_points", ratio(F.col("all_signed_error"), F.col("all_abs_y")))
    )


def bottom_up(fc: DataFrame, levels=("section", "store", "sku", "leaf")) -> DataFrame:
    """Metrics of every node from its leaves' parts; aggregate rows of the input are never read."""
    leaves = leaf_parts(fc, ["section", "store", "sku", "period_type"])
    nodes = level_sets(leaves, list(levels), ["period_type"], [F.sum(p).alias(p) for p in PARTS])
    return with_ratios(nodes).withColumn("unique_id", unique_id())


def cohort_metrics(fc: DataFrame, cohorts: Cohorts = Cohorts()) -> DataFrame:
    """Metrics over active leaves, with counts of leaves per cohort and the error on leaves without sales."""
    leaves = leaf_parts(fc, ["section", "store", "sku", "period_type"]).withColumn("metric_cohort", cohort(F.col("n_with_sales"), cohorts.active_days))
    active = F.col("metric_cohort") == "active"
    sums = [sum_if(active, F.col(p)).alias(p) for p in PARTS]
    counts = [F.count(F.when(F.col("metric_cohort") == c, 1)).alias(f"n_leaf_{c}") for c in ("active", "sparse", "zero")]
    zero = [sum_if(F.col("metric_cohort") == "zero", F.col("all_abs_error")).alias("zero_abs_error_sum")]
    return with_ratios(level_sets(leaves, ["section", "store", "sku", "leaf"], ["period_type"], sums + counts + zero))


def fill_missing(metrics: DataFrame, wanted: DataFrame) -> DataFrame:
    """Metrics of the wanted (section, store, sku) leaves; those without rows get zeros and null ratios."""
    keys = ["section", "store", "sku"]
    have = metrics.join(wanted, keys, "left_semi")
    missing = wanted.join(metrics, keys, "left_anti").select(*keys, F.lit(0).cast("long").alias("n_points"), F.lit(0).cast("long").alias("n_with_sales"), F.lit(0.0).alias("sum_y"))
    return have.unionByName(missing, allowMissingColumns=True)


def scope_in_out(fc: DataFrame, keys: list[str]) -> DataFrame:
    """In-sample, out-of-sample and total scalar metrics of a scope (0 where there is no denominator)."""
    parts = leaf_parts(fc, [*keys, "period_type"])
    out = []
    for name, condition in (("in", F.col("period_type") == "in_sample"), ("out", F.col("period_type") == "out_sample"), ("total", F.lit(True))):
        y = sum_if(condition, F.col("sum_abs_y"))
        out += [ratio_or_zero(sum_if(condition, F.col("sum_abs_error")), y).alias(f"wmape_{name}"), ratio_or_zero(sum_if(condition, F.col("sum_signed_error")), y).alias(f"bias_{name}")]
    return parts.groupBy(*keys).agg(*out, F.sum("n_points").alias("n_points"))


def scope_by_cohort(fc: DataFrame, keys: list[str], cohorts: Cohorts = Cohorts()) -> DataFrame:
    """Holdout metrics of a scope over active leaves, over sparse ones and over both, and what leaves without sales were forecast."""
    parts = leaf_parts(fc.where("period_type = 'out_sample'"), ["section", "store", "sku"]).withColumn("c", cohort(F.col("n_with_sales"), cohorts.active_days))
    out = []
    for name, condition in (("active", F.col("c") == "active"), ("sparse", F.col("c") == "sparse"), ("all", F.col("c") != "zero")):
        y = sum_if(condition, F.col("sum_abs_y"))
        out += [ratio_or_zero(sum_if(condition, F.col("sum_abs_error")), y).alias(f"wmape_{name}"), ratio_or_zero(sum_if(condition, F.col("sum_signed_error")), y).alias(f"bias_{name}"), F.count(F.when(condition, 1)).alias(f"n_{name}")]
    zero = F.col("c") == "zero"
    return parts.groupBy(*keys).agg(*out, F.count(F.when(zero, 1)).alias("n_zero"), sum_if(zero, F.col("all_abs_error")).alias("zero_demand_error"))


def long_units(fc: DataFrame) -> DataFrame:
    """Units and money as rows of one long table."""
    return fc.select("section", "store", "sku", "ds", "k", "period_type", F.expr("stack(2, 'units', y, yhat, 'value', value, valuehat) AS (unidad, y, yhat)"))


def per_unit_metrics(fc: DataFrame) -> DataFrame:
    """Section metrics per unit of measure, with the out-of-sample forecast total."""
    leaves = leaf_parts(long_units(fc), ["section", "unidad", "period_type"])
    return with_ratios(leaves).withColumn("forecast_oos_total", F.when(F.col("period_type") == "out_sample", F.col("sum_yhat")))


def prior_block_scores(fc: DataFrame, keys: list[str]) -> DataFrame:
    """Per block (older blocks have larger k): error and sales of all earlier blocks, and their ratio."""
    positive = F.col("y") > 0
    blocks = fc.groupBy(*keys, "k").agg(sum_if(positive, F.abs(F.col("yhat") - F.col("y"))).alias("e"), sum_if(positive, F.col("y")).alias("a"))
    before = Window.partitionBy(*keys).orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    out = blocks.select(*keys, "k", F.coalesce(F.sum("e").over(before), F.lit(0.0)).alias("prior_error"), F.coalesce(F.sum("a").over(before), F.lit(0.0)).alias("prior_sales"))
    return out.withColumn("prior_wmape", ratio(F.col("prior_error"), F.col("prior_sales")))


def parent_choice(fc: DataFrame) -> DataFrame:
    """Per store and block: the parent (store, or its section) that earlier blocks favour, frozen over the last block."""
    parents = fc.groupBy("section", "store", "ds", "k").agg(F.sum("y").alias("y"), F.sum("yhat").alias("yhat"))
    sections = fc.groupBy("section", "ds", "k").agg(F.sum("y").alias("y"), F.sum("yhat").alias("yhat"))
    store = prior_block_scores(parents, ["section", "store"]).select("section", "store", "k", F.col("prior_wmape").alias("store_wmape"))
    section = prior_block_scores(sections, ["section"]).select("section", "k", F.col("prior_wmape").alias("section_wmape"))
    both = store.join(section, ["section", "k"], "left")
    chosen = F.when(F.col("store_wmape").isNull() | F.col("section_wmape").isNull() | (F.col("store_wmape") <= F.col("section_wmape")), "store").otherwise("section")
    both = both.withColumn("chosen", chosen)
    whole = Window.partitionBy("section", "store").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    frozen = F.last(F.when(F.col("k") > 0, F.col("chosen")), ignorenulls=True).over(whole)
    return both.withColumn("parent_model", F.when(F.col("k") > 0, F.col("chosen")).otherwise(F.coalesce(frozen, F.lit("store"))))


def cumulative_metrics(fc: DataFrame) -> DataFrame:
    """Running wMAPE and bias of each leaf over its days with sales."""
    w = Window.partitionBy("section", "store", "sku").orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    sale = F.col("y") != 0
    a = F.sum(F.when(sale, F.abs("y")).otherwise(0.0)).over(w)
    e = F.sum(F.when(sale, F.abs(F.col("yhat") - F.col("y"))).otherwise(0.0)).over(w)
    s = F.sum(F.when(sale, F.col("yhat") - F.col("y")).otherwise(0.0)).over(w)
    return fc.select("section", "store", "sku", "ds", ratio(e, a).alias("running_wmape"), ratio(s, a).alias("running_bias"))


def discrepancy(fc: DataFrame, factor: float, scale: float) -> DataFrame:
    """Days whose actual and forecast are `factor` apart, the larger being above `scale` times the series' median."""
    high, low = F.greatest("y", "yhat"), F.least("y", "yhat")
    reference = F.median(F.when(F.col("y") > 0, F.col("y"))).over(Window.partitionBy("section", "store", "sku"))
    flagged = (high >= factor * F.greatest(low, F.lit(1.0))) & (high >= scale * F.coalesce(reference, F.lit(0.0)))
    return fc.withColumn("reference", reference).withColumn("flagged", flagged)

