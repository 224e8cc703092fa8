"""Statistical diagnostics over forecasts: candidate folds, residuals, strength, recurrence, zero rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_if, median_if, ratio, share_true, sum_if
from tidemark.operators.ranking import best_per_key, top_per_group

LEAF = ["section", "store", "sku"]


def candidate_folds(fc: DataFrame, keys: list[str], multiples=(0.5, 0.75, 1.0, 1.25)) -> DataFrame:
    """Error of scaled forecasts per node, candidate and block: a fold per block."""
    candidates = F.explode(F.array(*(F.lit(m) for m in multiples))).alias("candidate")
    rows = fc.where(F.col("y") > 0).select(*keys, "k", "period_type", "y", "yhat", candidates)
    return rows.groupBy(*keys, "candidate", "k", "period_type").agg(
        F.sum(F.abs(F.col("yhat") * F.col("candidate") - F.col("y"))).alias("abs_error"), F.sum("y").alias("abs_y")
    )


def fold_wins(folds: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates' total score and the folds in which none is better."""
    best = F.min("abs_error").over(Window.partitionBy(*keys, "k"))
    return folds.withColumn("won", F.col("abs_error") == best).groupBy(*keys, "candidate", "period_type").agg(
        F.count(F.lit(1)).alias("folds"), count_if(F.col("won")).alias("wins"), F.sum("abs_error").alias("abs_error"), F.sum("abs_y").alias("abs_y"), share_true(F.col("won")).alias("win_share"),
    )


def recommended(folds: DataFrame, keys: list[str]) -> DataFrame:
    """The history's best candidate per node, and how it and the current one fare on the holdout."""
    totals = folds.groupBy(*keys, "candidate", "period_type").agg(F.sum("abs_error").alias("e"), F.sum("abs_y").alias("a"))
    history = best_per_key(totals.where("period_type = 'in_sample'"), keys, F.asc("e"), F.asc("candidate")).select(*keys, F.col("candidate").alias("recommended"), F.col("e").alias("history_error"))
    holdout = totals.where("period_type = 'out_sample'").select(*keys, "candidate", F.col("e").alias("holdout_error"))
    current = holdout.where("candidate = 1.0").select(*keys, F.col("holdout_error").alias("current_error"))
    out = history.join(holdout.withColumnRenamed("candidate", "recommended"), [*keys, "recommended"], "left").join(current, keys, "left")
    verdict = (
        F.when(F.col("holdout_error").isNull() | F.col("current_error").isNull(), "no_holdout")
        .when(F.col("recommended") == 1.0, "keep_current")
        .when(F.col("holdout_error") < F.col("current_error"), "validated")
        .otherwise("vetoed")
    )
    return out.withColumn("status", verdict)


def compared_folds(folds: DataFrame, keys: list[str]) -> DataFrame:
    """Fold by fold gain of each candidate over the current one, weighted by sales."""
    current = folds.where("candidate = 1.0").select(*keys, "k", F.col("abs_error").alias("current_error"))
    joined = folds.where("period_type = 'in_sample'").join(current, [*keys, "k"])
    delta = ratio(F.col("current_error") - F.col("abs_error"), F.col("abs_y"))
    out = joined.withColumn("delta", delta).groupBy(*keys, "candidate").agg(
        F.sum(F.col("current_error") - F.col("abs_error")).alias("gain"), F.sum("abs_y").alias("weight"), share_true(F.col("delta") > 0).alias("share_better"), F.count(F.lit(1)).alias("folds"),
    )
    out = out.withColumn("weighted_delta", ratio(F.col("gain"), F.col("weight")))
    decision = (
        F.when((F.col("weighted_delta") >= 0.005) & (F.col("share_better") >= 0.6), "candidate")
        .when((F.col("weighted_delta") <= -0.005) & (F.col("share_better") <= 0.4), "reject")
        .otherwise("neutral")
    )
    return out.withColumn("decision", decision)


def residual_taxonomy(fc: DataFrame, limit: float = 4.0) -> DataFrame:
    """Classes of out-of-sample residuals per store: zero-sale, extreme over, extreme under, ordinary."""
    reference = fc.where((F.col("k") > 0) & (F.col("y") > 0)).groupBy(*LEAF).agg(F.median("y").alias("reference"))
    rows = fc.where("k = 0").join(reference, LEAF, "left")
    error = F.col("yhat") - F.col("y")
    kind = (
        F.when((F.col("y") == 0) & (F.col("yhat") > 0), "zero_sale")
        .when(error > limit * F.coalesce("reference", F.lit(0.0)), "extreme_over")
        .when(-error > limit * F.coalesce("reference", F.lit(0.0)), "extreme_under")
        .otherwise("ordinary")
    )
    out = rows.withColumn("kind", kind).groupBy("section", "store", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(error)).alias("abs_error"), F.max(F.abs(error)).alias("max_error"), median_if(F.col("y") > 0, F.col("y")).alias("median_y"))
    total = F.sum("abs_error").over(Window.partitionBy("section", "store"))
    return out.withColumn("error_share", ratio(F.col("abs_error"), total))


def residual_extremes(fc: DataFrame, per_store: int = 4) -> DataFrame:
    rows = fc.where("k = 0").withColumn("abs_error", F.abs(F.col("yhat") - F.col("y"))).withColumn("direction", F.when(F.col("yhat") > F.col("y"), "over").otherwise("under"))
    return top_per_group(rows, ["section", "store"], per_store, F.desc("abs_error"), F.asc("sku"), F.asc("ds"))


def gamma_strength(fc: DataFrame, gammas=(0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Per section the strength with which the latest block should move the older mean: history chooses, the holdout validates."""
    older = fc.groupBy(*LEAF).agg(sum_if(F.col("k") > 0, F.col("y")).alias("older"))
    blocks = fc.groupBy("section").agg(F.max("k").alias("older_blocks"))
    level = F.bround(F.col("older") / (F.greatest("older_blocks", F.lit(1)) * 28.0) * 16, 0) / 16
    rows = fc.where(F.col("y") > 0).join(older.join(blocks, "section").select(*LEAF, level.alias("level")), LEAF)
    rows = rows.withColumn("gamma", F.explode(F.array(*(F.lit(g) for g in gammas))))
    forecast = F.col("level") + F.col("gamma") * (F.col("yhat") - F.col("level"))
    grid = rows.groupBy("section", "gamma").agg(sum_if(F.col("k") > 0, F.abs(forecast - F.col("y"))).alias("history_error"), sum_if(F.col("k") == 0, F.abs(forecast - F.col("y"))).alias("holdout_error"))
    base = Window.partitionBy("section")
    grid = grid.withColumn("base_holdout", F.max(F.when(F.col("gamma") == 1.0, F.col("holdout_error"))).over(base))
    best = best_per_key(grid, ["section"], F.asc("history_error"), F.asc("gamma"))
    status = F.when(F.col("gamma") == 1.0, "keep_current").when(F.col("holdout_error") < F.col("base_holdout"), "validated_calibration").otherwise("holdout_regime_shift")
    return best.withColumn("status", status)


def calendar_recurrence(days: DataFrame, factor: float = 2.0, min_years: int = 2) -> DataFrame:
    """Month-days whose sales stand out against their year in several years."""
    daily = days.groupBy("section", "ds").agg(F.sum("y").alias("y")).withColumn("year", F.year("ds").cast("long"))
    mean = daily.groupBy("section", "year").agg(F.sum("y").alias("year_y"), F.count(F.lit(1)).alias("year_days"))
    rows = daily.join(mean, ["section", "year"]).withColumn("md", F.date_format("ds", "MM-dd"))
    high = F.col("y") * F.col("year_days") > factor * F.col("year_y")
    out = rows.groupBy("section", "md").agg(F.count(F.lit(1)).alias("years_seen"), count_if(high).alias("years_high"), F.max(F.when(high, F.col("year"))).alias("last_high"))
    status = F.when(F.col("years_high") >= min_years, "recurrent").when(F.col("years_high") == 1, "single").otherwise("none")
    return out.withColumn("status", status).where("years_high > 0")


def zero_rates(panel: DataFrame) -> DataFrame:
    """Share of dense store days without sales, in total, by weekday, by month and by 28-day block from the store's first day, in one pass."""
    first = F.min("ds").over(Window.partitionBy("section", "store"))
    rows = panel.withColumn("weekday", (F.weekday("ds") + 1).cast("long")).withColumn("month", F.month("ds").cast("long")).withColumn("block", F.floor(F.date_diff("ds", first) / 28))
    by = [F.col("section"), F.col("store")]
    out = rows.groupingSets([by, *([*by, F.col(c)] for c in ("weekday", "month", "block"))], *by, F.col("weekday"), F.col("month"), F.col("block"))
    return out.agg(F.count(F.lit(1)).alias("n_days"), count_if(F.col("y") == 0).alias("n_zero")).withColumn("zero_rate", ratio(F.col("n_zero").cast("double"), F.col("n_days").cast("double")))


def report(tables: dict[str, tuple[DataFrame, list, int]]) -> str:
    """Text report: the top rows of each table in its order."""
    out = []
    for title, (df, order, n) in tables.items():
        out.append(f"== {title}")
        out += ["  " + ", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in df.orderBy(*order).limit(n).collect()]
    return "\n".join(out)


def summary(records: DataFrame, keys: list[str], candidate: list[str], folds: list[str]) -> DataFrame:
    """Per key, period and candidate: error, bias, median and worst fold, and the folds in which no candidate is better.

    `records`: keys, candidate, folds (what makes up a fold within a key), period_type, abs_error, signed_error, abs_y."""
    fold = records.groupBy(*keys, *candidate, *[c for c in folds if c not in keys], "period_type").agg(F.sum("abs_error").alias("abs_error"), F.sum("signed_error").alias("signed_error"), F.sum("abs_y").alias("abs_y"))
    fold = fold.withColumn("wmape", ratio(F.col("abs_error"), F.col("abs_y")))
    best = F.min("wmape").over(Window.partitionBy(*keys, *[c for c in folds if c not in keys], "period_type"))
    fold = fold.withColumn("won", F.col("wmape") <= best + 1e-15)
    out = fold.groupBy(*keys, "period_type", *candidate).agg(
        F.sum("abs_error").alias("abs_error"), F.sum("signed_error").alias("signed_error"), F.sum("abs_y").alias("abs_y"), F.count(F.lit(1)).alias("n_folds"),
        F.median("wmape").alias("median_fold_wmape"), F.max("wmape").alias("worst_fold_wmape"), count_if(F.col("won")).alias("fold_wins"),
    )
    return out.withColumn("wmape", ratio(F.col("abs_error"), F.col("abs_y"))).withColumn("bias", ratio(F.col("signed_error"), F.col("abs_y")))


def ses_summary(records: DataFrame) -> DataFrame:
    """Smoothing weights by section and target; a fold is a block."""
    return summary(records, ["section", "target"], ["alpha"], ["block"])


def rls_summary(records: DataFrame) -> DataFrame:
    """Candidates by section, node level and target; a fold is a node's block."""
    return summary(records, ["section", "node_level", "target"], ["mode", "decay"], ["unique_id", "block"])


def rls_summary_by_node(records: DataFrame) -> DataFrame:
    return summary(records, ["section", "node_level", "unique_id", "target"], ["mode", "decay"], ["block"])


def recommendation(summarised: DataFrame, keys: list[str], candidate: list[str]) -> DataFrame:
    """The history's best candidate of each key (then by its worst fold, then by its values), next to its holdout, which only bears witness."""
    order = [F.asc_nulls_last("wmape"), F.asc_nulls_last("worst_fold_wmape"), *(F.asc(c) for c in candidate)]
    kept = [F.col(n).alias(f"history_{n}") for n in ("wmape", "bias", "median_fold_wmape", "worst_fold_wmape")]
    history = best_per_key(summarised.where("period_type = 'in_sample'"), keys, *order).select(*keys, *candidate, *kept, "n_folds")
    holdout = summarised.where("period_type = 'out_sample'").select(*keys, *candidate, F.col("wmape").alias("holdout_wmape"), F.col("bias").alias("holdout_bias"))
    return history.join(holdout, [*keys, *candidate], "left")


def ses_recommendation(summarised: DataFrame) -> DataFrame:
    return recommendation(summarised, ["section", "target"], ["alpha"])


def rls_recommendation(by_node: DataFrame) -> DataFrame:
    return recommendation(by_node, ["section", "node_level", "unique_id", "target"], ["mode", "decay"])


def driver_decisions(screen: DataFrame, margin: float = 0.005, most: float = 0.6) -> DataFrame:
    """Whether a group of drivers helps: history decides, the holdout confirms or vetoes."""
    delta = ratio(F.col("abs_error_without") - F.col("abs_error"), F.col("abs_y"))
    rows = screen.withColumn("delta", delta)
    sums = rows.groupBy("driver_group", "period_type").agg(F.sum(F.col("delta") * F.col("abs_y")).alias("gain"), F.sum("abs_y").alias("weight"), share_true(F.col("delta") > 0).alias("share_helped"))
    sums = sums.withColumn("weighted_delta", ratio(F.col("gain"), F.col("weight")))
    history = sums.where("period_type = 'in_sample'").select("driver_group", "weighted_delta", "share_helped")
    holdout = sums.where("period_type = 'out_sample'").select("driver_group", F.col("weighted_delta").alias("holdout_delta"))
    helps = (F.col("weighted_delta") >= margin) & (F.col("share_helped") >= most)
    harms = (F.col("weighted_delta") <= -margin) & (F.col("share_helped") <= 1 - most)
    kind = F.when(helps, "keep").when(harms & (F.col("holdout_delta") < 0), "candidate_remove").when(harms, "vetoed_by_holdout").otherwise("neutral")
    return history.join(holdout, "driver_group", "left").withColumn("decision", kind)
