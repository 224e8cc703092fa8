"""Leaf forecasts: smoothed levels moved by the effect of one parent."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Horizon, Ses
from tidemark.functions.exprs import ratio
from tidemark.functions.ses import AHEAD, HISTORY, HOLDOUT, walk_forward
from tidemark.sources.stage import dealt

LEAF = ["section", "store", "sku"]
PERIODS = {"in_sample": HISTORY, "out_sample": HOLDOUT, "forecast_only": AHEAD}
TRACES = ("ses_level", "ses_alpha", "leaf_forecast_cap", "leaf_gap_observable_days", "leaf_gap_decay_factor")
#: Of each target: its forecast, and the suffix of its driver columns.
TARGETS = {"y": ("yhat", ""), "value": ("valuehat", "_value")}
DRIVERS = ("effect", "raw", "reference", "center", "parent_forecast", "reference_level")
OUTPUT = (
    "section string, store string, sku string, ds date, period_type string, rls_block long, y double, value double, yhat_raw double, yhat double, valuehat_raw double, valuehat double, "
    "rls_metric_eligible boolean, leaf_warmup_end date, leaf_observable_day_index long, "
    + ", ".join(f"parent_model_{t} string, parent_wmape_{t} double, initial_level_{t} double, driver_factor_{t} double" for t in TARGETS)
    + ", "
    + ", ".join(f"driver_{d}_{t} double" for t in TARGETS for d in DRIVERS)
    + ", "
    + ", ".join(f"{t}_{u} double" for u in TARGETS for t in TRACES)
)
CANDIDATES = "section string, store string, sku string, target string, alpha double, period_type string, block long, abs_error double, signed_error double, abs_y double"


def parent_of(nodes: DataFrame, target: str) -> DataFrame:
    """Per store and day: the parent (store or section) that forecast this target better on all earlier blocks, frozen outside history, and its effect with traces."""
    hat, suffix = TARGETS[target]
    use = (F.col("period_type") == "in_sample") & F.col("eligible") & (F.col("y") > 0)
    blocks = nodes.groupBy("unique_id", "block").agg(F.sum(F.when(use, F.abs(F.col(hat) - F.col(target)))).alias("e"), F.sum(F.when(use, F.col(target))).alias("a"))
    before = Window.partitionBy("unique_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    score = blocks.select("unique_id", "block", ratio(F.sum("e").over(before), F.sum("a").over(before)).alias("wmape"))
    traces = {
        "effect": F.col(f"driver_effect{suffix}"), "raw": F.log1p(F.greatest(F.coalesce(hat, F.lit(0.0)), F.lit(0.0))), "reference": F.log1p(f"driver_reference{suffix}"), "center": F.col(f"driver_center{suffix}"),
        "parent_forecast": F.col(hat), "reference_level": F.col(f"driver_reference{suffix}"),
    }
    scored = nodes.join(score, ["unique_id", "block"]).select("section", "store", "ds", "period_type", "block", "wmape", *(c.alias(n) for n, c in traces.items()))
    sections = scored.where("store IS NULL").select("section", "ds", *(F.col(n).alias(f"section_{n}") for n in ("wmape", *traces)))
    both = scored.where("store IS NOT NULL").join(sections, ["section", "ds"], "left")
    better = F.when(F.col("wmape").isNull() | F.col("section_wmape").isNull() | (F.col("wmape") <= F.col("section_wmape")), "store").otherwise("section")
    last = F.last(F.when(F.col("period_type") == "in_sample", better), ignorenulls=True).over(Window.partitionBy("section", "store").orderBy("ds").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    both = both.withColumn("parent", F.when(F.col("period_type") == "in_sample", better).otherwise(F.coalesce(last, F.lit("store"))))

    def of_parent(n):
        return F.when(F.col("parent") == "store", F.col(n)).otherwise(F.col(f"section_{n}"))

    return both.select(
        "section", "store", "ds", "period_type", "block", F.col("parent").alias(f"parent_model_{target}"), of_parent("wmape").alias(f"parent_wmape_{target}"),
        *(F.coalesce(of_parent(n), F.lit(0.0)).alias(f"driver_{n}_{target}") for n in traces),
    )


def selected_parent(nodes: DataFrame, cadence: int) -> DataFrame:
    """The parents of both targets; units and money choose on their own."""
    rows = nodes.where(F.col("cadence") == cadence)
    return parent_of(rows, "y").join(parent_of(rows, "value").drop("period_type", "block"), ["section", "store", "ds"])


def leaf_rows(days: DataFrame, parents: DataFrame, horizon: Horizon = Horizon()) -> DataFrame:
    """Observed leaf days in history, every day of holdout and horizon for leaves known before, with store observability."""
    w = Window.partitionBy("section", "store").orderBy("ds")
    calendar = parents.withColumn("index", F.row_number().over(w).cast("long"))
    history = days.select(*LEAF, "ds", "y", "value")
    known = calendar.where("period_type = 'in_sample'").select("section", "store", "ds").join(history, ["section", "store", "ds"]).select(*LEAF).distinct()
    grid = known.join(calendar, ["section", "store"]).join(history, [*LEAF, "ds"], "left")
    return grid.where("y IS NOT NULL OR period_type <> 'in_sample'").fillna(0.0, ["y", "value"])


def leaf_walks(frame: pd.DataFrame, records: dict[str, list] | None = None):
    """(target, rows before the first forecast, initial level, effect, walk) of one leaf, in order of its store's observable days."""
    period = frame["period_type"].map(PERIODS).to_numpy()
    ds = pd.to_datetime(frame["ds"])
    warm = ((ds - ds.min()).dt.days.to_numpy() < 28) & (period == HISTORY)
    y, index, block = frame["y"].to_numpy(dtype=float), frame["index"].to_numpy(), frame["block"].to_numpy()
    for target in TARGETS:
        x = frame[target].to_numpy(dtype=float)
        positive = x[warm & (x > 0)]
        initial = float(np.median(positive)) if len(positive) else 0.0
        effect = np.where(warm, 0.0, frame[f"driver_effect_{target}"].to_numpy(dtype=float))
        walk = walk_forward(x, index, block, period, effect, initial, warm, support=(y > 0) & (x > 0), records=None if records is None else records.setdefault(target, []))
        yield target, warm, initial, effect, walk


def forecast_leaf(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["index"], ignore_index=True)
    names = [c.split()[0] for c in OUTPUT.split(", ")]
    out = {n: frame[n] for n in names if n in frame.columns}
    out["rls_block"], out["leaf_observable_day_index"] = frame["block"], frame["index"]
    out["leaf_warmup_end"] = (pd.to_datetime(frame["ds"]).min() + pd.Timedelta(days=27)).date()
    for target, warm, initial, effect, walk in leaf_walks(frame):
        hat = TARGETS[target][0]
        out[f"{hat}_raw"], out[hat] = walk["forecast"], np.round(walk["forecast"], 0 if target == "y" else 2)
        out[f"driver_effect_{target}"], out[f"driver_factor_{target}"], out[f"initial_level_{target}"] = effect, np.exp(effect), initial
        for trace, key in zip(TRACES, ("level", "alpha", "cap", "gap", "factor")):
            out[f"{trace}_{target}"] = walk[key]
        if target == "y":
            out["rls_metric_eligible"] = walk["eligible"]
    return pd.DataFrame(out)[names]


def leaf_forecasts(days: DataFrame, nodes: DataFrame, cadence: int = 28) -> DataFrame:
    return dealt(leaf_rows(days, selected_parent(nodes, cadence)), *LEAF).groupBy(*LEAF).applyInPandas(forecast_leaf, OUTPUT)


def leaf_candidates(days: DataFrame, nodes: DataFrame, cadence: int = 28, alphas=Ses().alphas) -> DataFrame:
    """Every smoothing weight's errors in every block of every leaf, for both targets."""
    names = [c.split()[0] for c in CANDIDATES.split(", ")]
    called = {v: k for k, v in PERIODS.items()}

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["index"], ignore_index=True)
        records: dict[str, list] = {}
        for _ in leaf_walks(frame, records):
            pass
        key = [frame[c][0] for c in LEAF]
        rows = [(*key, target, alpha, called[period], block, e, s, a) for target, found in records.items() for period, block, errors, signed, a in found for alpha, e, s in zip(alphas, errors, signed)]
        return pd.DataFrame(rows, columns=names)

    return dealt(leaf_rows(days, selected_parent(nodes, cadence)), *LEAF).groupBy(*LEAF).applyInPandas(run, CANDIDATES)


def parent_candidates(forecast: DataFrame, nodes: DataFrame, cadence: int = 28) -> DataFrame:
    """Error of each leaf, target and block if its level moved with the store's or with the section's effect, next to the policy's own."""
    rows = nodes.where(F.col("cadence") == cadence)

    def effects(at, name):
        return rows.where(at).select("section", *(["store"] if name == "store" else []), "ds", *(F.col(f"driver_effect{suffix}").alias(f"{name}_effect_{t}") for t, (_, suffix) in TARGETS.items()))

    scored = forecast.where(F.col("rls_metric_eligible") & (F.col("y") > 0)).join(effects("store IS NOT NULL", "store"), ["section", "store", "ds"], "left").join(effects("store IS NULL", "section"), ["section", "ds"], "left")
    sides = ", ".join(f"'{t}', '{c}', {t}, {hat}_raw, ses_level_{t}, leaf_forecast_cap_{t}, coalesce({c}_effect_{t}, 0D)" for t, (hat, _) in TARGETS.items() for c in ("store", "section"))
    long = scored.select(*LEAF, "period_type", "rls_block", F.expr(f"stack(4, {sides}) AS (target, candidate, actual, issued, level, cap, effect)"))
    hat = F.least(F.greatest(F.expm1(F.log1p("level") + F.col("effect")), F.lit(0.0)), F.col("cap"))
    return long.groupBy(*LEAF, "target", "candidate", "period_type", "rls_block").agg(
        F.sum(F.abs(hat - F.col("actual"))).alias("abs_error"), F.sum(F.abs(F.col("issued") - F.col("actual"))).alias("current_error"), F.sum("actual").alias("abs_y")
    )


def parent_summary(folds: DataFrame) -> DataFrame:
    """Per section, target, parent and period: errors of the candidate and of the policy, and the blocks in which it is better."""
    blocks = folds.groupBy("section", "target", "candidate", "period_type", "rls_block").agg(F.sum("abs_error").alias("abs_error"), F.sum("current_error").alias("current_error"), F.sum("abs_y").alias("abs_y"))
    out = blocks.groupBy("section", "target", "candidate", "period_type").agg(
        F.sum("abs_error").alias("abs_error"), F.sum("current_error").alias("current_error"), F.sum("abs_y").alias("abs_y"), F.count(F.lit(1)).alias("n_blocks"), F.count(F.when(F.col("abs_error") < F.col("current_error"), 1)).alias("blocks_better")
    )
    return out.withColumn("wmape", ratio(F.col("abs_error"), F.col("abs_y"))).withColumn("current_wmape", ratio(F.col("current_error"), F.col("abs_y")))


def parent_switches(folds: DataFrame, margin: float = 0.005, most: float = 0.6) -> DataFrame:
    """Per section (and target) and parent: whether history speaks for a switch to it, and whether the holdout bears it out (it can't create one)."""
    keys = [c for c in ("section", "target", "candidate") if c in folds.columns]
    better = (F.col("abs_error") < F.col("current_error")).cast("double")
    sums = folds.groupBy(*keys, "period_type").agg(F.sum(F.col("current_error") - F.col("abs_error")).alias("gain"), F.sum("abs_y").alias("weight"), F.avg(better).alias("share_better"), F.count(F.lit(1)).alias("folds"))
    sums = sums.withColumn("delta", ratio(F.col("gain"), F.col("weight")))
    history = sums.where("period_type = 'in_sample'").select(*keys, "delta", "share_better", "folds")
    holdout = sums.where("period_type = 'out_sample'").select(*keys, F.col("delta").alias("holdout_delta"))
    wanted = (F.col("delta") >= margin) & (F.col("share_better") >= most)
    status = F.when(~wanted, "keep_policy").when(F.col("holdout_delta") > 0, "validated_parent_switch").otherwise("vetoed_by_holdout")
    return history.join(holdout, keys, "left").withColumn("status", F.coalesce(status, F.lit("keep_policy")))
