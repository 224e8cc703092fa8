"""Block-causal RLS forecasts of section and store nodes: one grouped map, all cadences from one path."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import CADENCES, Horizon, Rls
from tidemark.functions.effect import relative_effect
from tidemark.functions.exprs import unique_id
from tidemark.functions.rls import coefficient_path, lag_matrix, predict_log_ar, predict_log_base
from tidemark.operators.calendar import MONTHS, RAMPS, WEEKDAYS, calendar_dummies, holiday_offsets, holiday_ramp, holiday_table, offset_columns
from tidemark.operators.panel import horizons
from tidemark.operators.price import decompose, last_prices
from tidemark.sources.stage import dealt, stage

PRICES = ["asp", "edp", "discount"]
CALENDAR = [*WEEKDAYS.values(), *MONTHS.values(), *offset_columns(), *RAMPS]

OUTPUT = (
    "unique_id string, section string, store string, cadence int, ds date, period_type string, block long, y double, value double, "
    "yhat double, valuehat double, mode_y string, decay_y double, mode_value string, decay_value double, eligible boolean, "
    "driver_effect double, driver_reference double, driver_center double, driver_effect_value double, driver_reference_value double, driver_center_value double"
)


def node_panel(spark: SparkSession, days: DataFrame, horizon: Horizon = Horizon()) -> DataFrame:
    """Dense days of section and store nodes with causal prices and calendar drivers: all of the canonical training window, holdout and forecast horizon.

    The facts are read once: the sums of the nodes are a stage, and all that follows reads them."""
    sums = stage(days.groupingSets([[F.col("section"), F.col("ds")], [F.col("section"), F.col("store"), F.col("ds")]], F.col("section"), F.col("store"), F.col("ds")).agg(F.sum("y").alias("y"), F.sum("value").alias("value")))
    windows = horizons(sums, horizon).select("section", F.col("train_start").alias("start"), F.col("oos_end").alias("last_ds"))
    nodes = sums.join(windows, "section").where("ds >= start").withColumn("unique_id", unique_id("section", "store", None))
    keys = ["unique_id", "section"]
    grid = nodes.groupBy(*keys).agg(F.max("store").alias("store"), F.min("start").alias("start"), F.max("last_ds").alias("last_ds"))
    grid = grid.select("*", F.explode(F.sequence("start", F.date_add("last_ds", horizon.forecast_days))).alias("ds"))
    panel = grid.join(nodes.select("unique_id", "ds", "y", "value"), ["unique_id", "ds"], "left").fillna(0.0, ["y", "value"])
    oos_start = F.date_sub("last_ds", horizon.oos_days - 1)
    panel = panel.withColumn("period_type", F.when(F.col("ds") > F.col("last_ds"), "forecast_only").when(F.col("ds") >= oos_start, "out_sample").otherwise("in_sample"))
    # Prices look some rows ahead, so the holdout and the horizon only see the last price of what precedes them.
    train = decompose(panel.where("period_type = 'in_sample'"), ["unique_id"]).select("unique_id", "ds", *PRICES)
    carried = last_prices(train, ["unique_id"]).select("unique_id", *(F.col(p).alias(f"last_{p}") for p in PRICES))
    panel = panel.join(train, ["unique_id", "ds"], "left").join(carried, "unique_id", "left")
    panel = panel.select(*keys, "store", "ds", "period_type", "y", "value", *(F.coalesce(p, f"last_{p}", F.lit(0.0)).alias(p) for p in PRICES))
    dates = panel.select("ds").distinct()
    years = dates.agg(F.min(F.year("ds")), F.max(F.year("ds"))).first()
    holidays = holiday_table(spark, range((years[0] or 2000) - 1, (years[1] or 2000) + 2))
    drivers = calendar_dummies(dates).join(holiday_offsets(dates, holidays), "ds")
    for ramp in RAMPS:
        drivers = drivers.join(holiday_ramp(dates, holidays, ramp), "ds")
    return panel.join(drivers, "ds")


def blocks_of(period: np.ndarray, size: int, seed: int) -> list[tuple[int, int]]:
    """Forecast blocks: they restart where the period changes, and begin after the seed rows."""
    out, at = [], seed
    while at < len(period):
        end = at
        while end < len(period) and end - at < size and period[end] == period[at]:
            end += 1
        out.append((at, end))
        at = end
    return out


def forecast_node(frame: pd.DataFrame, cadences=CADENCES, rls: Rls = Rls()) -> pd.DataFrame:
    frame = frame.sort_values("ds", ignore_index=True)
    period = frame["period_type"].to_numpy()
    known = period != "forecast_only"
    n_known = int(known.sum())
    calendar = np.column_stack([np.ones(len(frame)), frame[CALENDAR].to_numpy(dtype=float)])
    designs = {"y": np.column_stack([calendar, np.nan_to_num(frame[PRICES].to_numpy(dtype=float))]), "value": calendar}
    candidates = [(m, d) for m in rls.modes for d in rls.decays]
    seed = rls.seed_days
    paths, targets = {}, {}
    for target, x in designs.items():
        z = np.log1p(np.maximum(frame[target].to_numpy(dtype=float), 0.0))
        targets[target] = z
        lags = lag_matrix(z[:n_known])
        floor = rls.min_y_units if target == "y" else rls.min_y_value
        for mode, decay in candidates:
            rows = x[:n_known] if mode == "base" else np.column_stack([x[:n_known], lags])
            paths[target, mode, decay] = coefficient_path(rows, z[:n_known], decay, floor, seed, rls.prior_scale)
    out = []
    actual = {t: frame[t].to_numpy(dtype=float) for t in designs}
    for cadence in cadences:
        result = frame[["unique_id", "section", "store", "ds", "period_type", "y", "value"]].copy()
        result["cadence"] = cadence
        block = np.full(len(frame), -1)
        columns = {}
        for target, x in designs.items():
            hat = np.full(len(frame), np.nan)
            mode_used, decay_used = np.full(len(frame), None, dtype=object), np.full(len(frame), np.nan)
            error = dict.fromkeys(candidates, 0.0)
            chosen, frozen = rls.default, False
            for number, (a, b) in enumerate(blocks_of(period, cadence, seed)):
                a_coef = min(a, n_known) - 1
                if a_coef < 0:
                    continue
                if period[a] == "in_sample":
                    if any(error.values()):
                        chosen = min(candidates, key=lambda c: (error[c], c))
                elif not frozen:
                    if any(error.values()):
                        chosen = min(candidates, key=lambda c: (error[c], c))
                    frozen = True
                ahead = {}
                for mode, decay in candidates if period[a] == "in_sample" else [chosen]:
                    coef = paths[target, mode, decay][a_coef]
                    ahead[mode, decay] = predict_log_base(x[a:b], coef) if mode == "base" else predict_log_ar(x[a:b], coef, targets[target][: min(a, n_known)])
                hat[a:b] = ahead[chosen]
                mode_used[a:b], decay_used[a:b], block[a:b] = chosen[0], chosen[1], number
                if period[a] == "in_sample":
                    use = frame["y"].to_numpy()[a:b] > 0
                    for c, f in ahead.items():
                        error[c] += float(np.abs(f[use] - actual[target][a:b][use]).sum())
            columns[target] = (np.round(hat, 0 if target == "y" else 2), mode_used, decay_used)
        result["block"] = block
        for target, suffix in (("y", ""), ("value", "_value")):
            own = relative_effect(actual[target], columns[target][0], block, known)
            result[f"driver_effect{suffix}"] = np.where(block >= 0, own["effect"], 0.0)
            result[f"driver_reference{suffix}"], result[f"driver_center{suffix}"] = own["reference"], own["centre"]
        result["yhat"], result["mode_y"], result["decay_y"] = columns["y"]
        result["valuehat"], result["mode_value"], result["decay_value"] = columns["value"]
        result["eligible"] = np.isfinite(result["yhat"].to_numpy(dtype=float)) & known
        out.append(result)
    whole = pd.concat(out, ignore_index=True)
    whole[["yhat", "valuehat", "decay_y", "decay_value"]] = whole[["yhat", "valuehat", "decay_y", "decay_value"]].astype(object).where(np.isfinite(whole[["yhat", "valuehat", "decay_y", "decay_value"]].to_numpy(dtype=float)), None)
    return whole[[c.split()[0] for c in OUTPUT.split(", ")]]


def node_forecasts(panel: DataFrame, cadences=CADENCES) -> DataFrame:
    """One group a node: its days from the start of training to the forecast horizon."""
    return dealt(panel, "unique_id").groupBy("unique_id").applyInPandas(lambda frame: forecast_node(frame, cadences), OUTPUT)


# --- candidate records and driver screens --------------------------------------------------------

DRIVER_GROUPS = {
    "price": PRICES,
    "weekday": list(WEEKDAYS.values()),
    "month": list(MONTHS.values()),
    "holiday": list(offset_columns()),
    "ramp": list(RAMPS),
}
CANDIDATES = "unique_id string, section string, node_level string, target string, mode string, decay double, period_type string, block long, abs_error double, signed_error double, abs_y double, n_days long"
SCREEN = "unique_id string, driver_group string, period_type string, block long, abs_error double, abs_error_without double, abs_y double"


def block_scores(x: np.ndarray, frame: pd.DataFrame, target: str, mode: str, decay: float, size: int, rls: Rls) -> list[tuple[str, int, float, float, float, int]]:
    """Period, block, error, signed error and sales of a candidate's causal forecasts, block by block of known days."""
    period = frame["period_type"].to_numpy()
    n = int((period != "forecast_only").sum())
    actual, units = frame[target].to_numpy(dtype=float), frame["y"].to_numpy(dtype=float)
    z = np.log1p(np.maximum(actual, 0.0))
    rows = x[:n] if mode == "base" else np.column_stack([x[:n], lag_matrix(z[:n])])
    path = coefficient_path(rows, z[:n], decay, rls.min_y_units if target == "y" else rls.min_y_value, rls.seed_days, rls.prior_scale)
    out = []
    for number, (a, b) in enumerate(blocks_of(period[:n], size, rls.seed_days)):
        hat = predict_log_base(x[a:b], path[a - 1]) if mode == "base" else predict_log_ar(x[a:b], path[a - 1], z[:a])
        use = units[a:b] > 0
        miss = (hat - actual[a:b])[use]
        out.append((period[a], number, float(np.abs(miss).sum()), float(miss.sum()), float(np.abs(actual[a:b])[use].sum()), int(use.sum())))
    return out


def designs_of(frame: pd.DataFrame) -> dict[str, np.ndarray]:
    calendar = np.column_stack([np.ones(len(frame)), frame[CALENDAR].to_numpy(dtype=float)])
    return {"y": np.column_stack([calendar, np.nan_to_num(frame[PRICES].to_numpy(dtype=float))]), "value": calendar}


def node_candidates(panel: DataFrame, size: int = 28, rls: Rls = Rls()) -> DataFrame:
    """Every candidate's score in every block of every node."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ds", ignore_index=True)
        out = [
            (frame["unique_id"][0], frame["section"][0], "section" if frame["store"].isna().all() else "store", target, mode, decay, *score)
            for target, x in designs_of(frame).items()
            for mode in rls.modes
            for decay in rls.decays
            for score in block_scores(x, frame, target, mode, decay, size, rls)
        ]
        return pd.DataFrame(out, columns=[c.split()[0] for c in CANDIDATES.split(", ")])

    return dealt(panel, "unique_id").groupBy("unique_id").applyInPandas(run, CANDIDATES)


def driver_screen(panel: DataFrame, size: int = 28, rls: Rls = Rls()) -> DataFrame:
    """Exact refits of the default unit model without each group of drivers, next to the full model."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ds", ignore_index=True)
        x, names = designs_of(frame)["y"], ["intercept", *CALENDAR, *PRICES]
        full, out = block_scores(x, frame, "y", *rls.default, size, rls), []
        for group, columns in DRIVER_GROUPS.items():
            reduced = x.copy()
            reduced[:, [names.index(c) for c in columns]] = 0.0
            for (period, number, error, _, sales, _), other in zip(full, block_scores(reduced, frame, "y", *rls.default, size, rls)):
                out.append((frame["unique_id"][0], group, period, number, error, other[2], sales))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCREEN.split(", ")])

    return dealt(panel, "unique_id").groupBy("unique_id").applyInPandas(run, SCREEN)
