"""Roll-ups over the hierarchy, in one pass of grouping sets, and resampling over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import is_finite, unique_id

LEVELS = {("section",): "section", ("section", "store"): "store", ("section", "sku"): "sku", ("section", "store", "sku"): "leaf"}


def level_sets(df: DataFrame, levels: list[str], extra: list[str], aggregates: list) -> DataFrame:
    """Aggregates at the named levels; absent keys are null and `level` tells them apart."""
    sets = [list(keys) + extra for keys, name in LEVELS.items() if name in levels]
    keys = ["section", "store", "sku", *extra]
    store_gone, sku_gone = F.grouping("store"), F.grouping("sku")
    level = F.when((store_gone == 1) & (sku_gone == 1), "section").when(sku_gone == 1, "store").when(store_gone == 1, "sku").otherwise("leaf")
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *(F.col(k) for k in keys)).agg(*aggregates, level.alias("level"))


def rollup_levels(rows: DataFrame) -> DataFrame:
    """Units, money and row count of sections, stores and leaves by day; pure SKU nodes are left out."""
    valid = rows.where(F.col("y") >= 0)
    out = level_sets(valid, ["section", "store", "leaf"], ["ds"], [F.sum("y").alias("y"), F.sum("value").alias("value"), F.count("y").alias("n")])
    return out.withColumn("unique_id", unique_id())


def bottom_up_series(fc: DataFrame) -> DataFrame:
    """Daily series of sections, stores and pure SKUs; error parts are summed after their absolute value per leaf."""
    ok = is_finite(F.col("y")) & is_finite(F.col("yhat"))
    sums = [F.sum("y").alias("y"), F.sum("yhat").alias("yhat"), F.sum(F.when(ok & (F.col("y") != 0), F.abs(F.col("yhat") - F.col("y")))).alias("abs_error"), F.count(F.lit(1)).alias("n_leaves")]
    return level_sets(fc, ["section", "store", "sku"], ["ds"], sums)


def pure_sku_series(fc: DataFrame) -> DataFrame:
    return fc.groupBy("section", "sku", "ds").agg(F.sum("y").alias("y"), F.sum("yhat").alias("yhat"), F.sum("value").alias("value"))


def resample(series: DataFrame, frequency: str, keys: list[str]) -> DataFrame:
    """Weeks from Monday, or months; a bucket's date is its first day with data."""
    bucket = F.to_date(F.date_trunc(frequency, "ds"))
    return (
        series.groupBy(*keys, "period_type", bucket.alias("bucket"))
        .agg(F.min("ds").alias("ds"), F.sum("y").alias("y"), F.sum("yhat").alias("yhat"), F.count(F.lit(1)).alias("n"))
    )
