"""Serving tables: index, labels, metrics and series, and what a view of one node needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import display_label, ratio, unique_id
from tidemark.operators.metrics import bottom_up, leaf_parts, with_ratios
from tidemark.operators.ranking import ranked
from tidemark.operators.rollup import bottom_up_series, resample


def index(days: DataFrame, horizons: DataFrame) -> DataFrame:
    """One row a section: sorted node lists, who is seen with whom, spine length and windows."""
    stores = days.groupBy("section", "store").agg(F.sort_array(F.collect_set("sku")).alias("skus"))
    skus = days.groupBy("section", "sku").agg(F.sort_array(F.collect_set("store")).alias("stores"))
    by_store = stores.groupBy("section").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("store", "skus")))).alias("skus_of_store"))
    by_sku = skus.groupBy("section").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("sku", "stores")))).alias("stores_of_sku"))
    spine = days.groupBy("section").agg(F.count_distinct("ds").alias("n_days"), F.sort_array(F.collect_set("store")).alias("stores"), F.sort_array(F.collect_set("sku")).alias("skus"))
    return spine.join(by_store, "section").join(by_sku, "section").join(horizons, "section", "left")


def node_metrics(fc: DataFrame) -> DataFrame:
    """Metrics of all nodes with ids and labels, as served."""
    return bottom_up(fc).withColumn("label", display_label(F.col("section"), F.col("store"), F.col("sku")))


def node_series(fc: DataFrame) -> DataFrame:
    """Leaf and bottom-up series in one table, keyed by id."""
    leaves = fc.select("section", "store", "sku", "ds", "period_type", "y", "yhat", F.lit("leaf").alias("level"))
    periods = fc.select("section", "ds", "period_type").distinct()
    nodes = bottom_up_series(fc).join(periods, ["section", "ds"]).select("section", "store", "sku", "ds", "period_type", "y", "yhat", "level")
    return leaves.unionByName(nodes).withColumn("unique_id", unique_id())


def period_rows(df: DataFrame, period: str, windows: DataFrame | None = None) -> DataFrame:
    """The rows of a period: by their mark, or by the section's windows where the table has no marks."""
    if "period_type" in df.columns:
        return df.where(F.col("period_type") == period)
    first, last = {"in_sample": ("train_start", "train_end"), "out_sample": ("oos_start", "oos_end"), "forecast_only": ("forecast_start", "forecast_end")}[period]
    return df.join(windows.select("section", F.col(first).alias("from_ds"), F.col(last).alias("to_ds")), "section").where(F.col("ds").between(F.col("from_ds"), F.col("to_ds"))).drop("from_ds", "to_ds")


def chart_series(series: DataFrame, uid: str) -> DataFrame:
    """One node's days with the part of the chart that they belong to."""
    part = F.when(F.col("period_type") == "forecast_only", "forecast").when(F.col("period_type") == "out_sample", "holdout").otherwise("history")
    return series.where(F.col("unique_id") == uid).select("ds", part.alias("part"), "y", "yhat")


def node_view(metrics: DataFrame, series: DataFrame, section: str, store: str | None = None, sku: str | None = None, frequency: str = "week") -> dict[str, DataFrame]:
    """Official figures (read, never computed anew), resampled series and rankings of one node."""

    def at(df):
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in (("section", section), ("store", store), ("sku", sku))]
        return df.where(same[0] & same[1] & same[2])

    out = metrics.where((F.col("section") == section) & (F.col("period_type") == "out_sample"))
    stores, skus = ("store", "leaf")[sku is not None], ("sku", "leaf")[store is not None]
    of_sku = F.col("sku").eqNullSafe(F.lit(sku))
    of_store = F.col("store").eqNullSafe(F.lit(store))
    return {
        "figures": at(metrics),
        "series": resample(at(series), frequency, ["unique_id"]),
        "stores": ranked(out.where((F.col("level") == stores) & of_sku), ["section"], ["store"]).withColumn("selected", F.col("store").eqNullSafe(F.lit(store))).orderBy(F.desc("selected"), "rank"),
        "skus": ranked(out.where((F.col("level") == skus) & of_store), ["section"], ["sku"]).withColumn("selected", F.col("sku").eqNullSafe(F.lit(sku))).orderBy(F.desc("selected"), "rank"),
    }


def cadence_comparison(by_cadence: DataFrame) -> DataFrame:
    """Section metrics of each cadence side by side; `by_cadence` is a forecast with a cadence column."""
    return with_ratios(leaf_parts(by_cadence, ["section", "cadence", "period_type"]))


def leaf_audit(forecast: DataFrame) -> dict[str, DataFrame]:
    """Detail with running error, a row a block, and a summary of one leaf's forecast."""
    keys = ["section", "store", "sku"]
    sale = (F.col("y") != 0) & (F.col("period_type") != "forecast_only")
    error = F.when(sale, F.abs(F.col("yhat") - F.col("y"))).otherwise(0.0)
    size = F.when(sale, F.abs("y")).otherwise(0.0)
    w = Window.partitionBy(*keys).orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    detail = forecast.withColumn("weekday", F.date_format("ds", "EEEE")).withColumn("running_wmape", ratio(F.sum(error).over(w), F.sum(size).over(w)))

    def summed(*by):
        out = forecast.groupBy(*keys, *by).agg(F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), F.sum("y").alias("y"), F.sum("yhat").alias("yhat"), F.sum(error).alias("abs_error"), F.sum(size).alias("abs_y"))
        return out.withColumn("wmape", ratio(F.col("abs_error"), F.col("abs_y")))

    return {"detail": detail, "blocks": summed("period_type", "rls_block"), "summary": summed("period_type")}


def forecast_totals(forecast: DataFrame) -> DataFrame:
    """Forecast total per SKU and store over the horizon, for the export."""
    return forecast.where(F.col("period_type") == "forecast_only").groupBy("section", "sku", "store").agg(F.sum("yhat").alias("yhat"), F.sum("valuehat").alias("valuehat"))


def kpi_differences(view: DataFrame, metrics: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Figures of a view that differ from the official table."""
    keys = ["unique_id", "period_type"]
    joined = view.select(*keys, F.col("wmape").alias("shown")).join(metrics.select(*keys, "wmape"), keys, "left")
    same = F.coalesce(F.abs(F.col("shown") - F.col("wmape")) <= tolerance, F.col("shown").isNull() & F.col("wmape").isNull())
    return joined.where(~same)
