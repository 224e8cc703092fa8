"""Dense calendars, horizons, observability and causal features over days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Horizon


def horizons(days: DataFrame, horizon: Horizon = Horizon()) -> DataFrame:
    """Train, out-of-sample and forecast windows of each section; training has whole blocks only."""
    bounds = days.groupBy("section").agg(F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))
    out = bounds.withColumn("oos_start", F.date_sub("last_ds", horizon.oos_days - 1))
    out = out.withColumn("train_end", F.date_sub("oos_start", 1))
    length = F.floor((F.date_diff("train_end", "first_ds") + 1) / 28) * 28
    out = out.withColumn("train_days", length.cast("long")).where("train_days >= 28")
    return out.select(
        "section", "first_ds", F.expr("date_sub(train_end, CAST(train_days AS INT) - 1)").alias("train_start"), "train_end", "oos_start",
        F.col("last_ds").alias("oos_end"), F.date_add("last_ds", 1).alias("forecast_start"), F.date_add("last_ds", horizon.forecast_days).alias("forecast_end"), "train_days",
    )


def dense_panel(rows: DataFrame, keys: list[str], first: str, last: str, measures: list[str]) -> DataFrame:
    """Every day of first..last (columns of `rows`) for each key, measures 0 where there was no row."""
    grid = rows.groupBy(*keys).agg(F.min(first).alias("a"), F.max(last).alias("b")).select(*keys, F.explode(F.sequence("a", "b")).alias("ds"))
    facts = rows.groupBy(*keys, "ds").agg(*(F.sum(m).alias(m) for m in measures))
    return grid.join(facts, [*keys, "ds"], "left").select(*keys, "ds", *(F.coalesce(m, F.lit(0.0)).alias(m) for m in measures), F.lit(1).cast("byte").alias("intercept"))


def observable_sequence(days: DataFrame) -> DataFrame:
    """Store days in order, how many observable days lie before each, and the first day of its 28-day block."""
    stores = days.groupBy("section", "store", "ds").agg(F.sum("y").alias("y"))
    first = Window.partitionBy("section", "store")
    before = first.orderBy("ds").rowsBetween(Window.unboundedPreceding, -1)
    out = stores.withColumn("first_ds", F.min("ds").over(first))
    out = out.withColumn("seen_before", F.count(F.lit(1)).over(before)).withColumn("block", F.floor(F.date_diff("ds", "first_ds") / 28))
    block = Window.partitionBy("section", "store", "block")
    return out.select("section", "store", "ds", "seen_before", "block", F.min("ds").over(block).alias("block_origin"))


def gap_days(days: DataFrame) -> DataFrame:
    """Days since a leaf's previous positive sale."""
    w = Window.partitionBy("section", "store", "sku").orderBy("ds")
    positive = days.where(F.col("y") > 0)
    return positive.select("section", "store", "sku", "ds", F.lag("ds").over(w).alias("previous_ds"), F.date_diff("ds", F.lag("ds").over(w)).cast("long").alias("gap"))


def ar_features(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Lags 7 and 28 and trailing means 7 and 28 of the dense series before each day; 0 where there is none."""
    w = Window.partitionBy(*keys).orderBy("ds")

    def zero(c):
        return F.coalesce(c, F.lit(0.0))

    return panel.select(
        *keys, "ds", "y",
        zero(F.lag("y", 7).over(w)).alias("lag_7"), zero(F.lag("y", 28).over(w)).alias("lag_28"),
        zero(F.avg("y").over(w.rowsBetween(-7, -1))).alias("mean_7"), zero(F.avg("y").over(w.rowsBetween(-28, -1))).alias("mean_28"),
    )


def trailing_median(panel: DataFrame, keys: list[str], days: int = 28) -> DataFrame:
    """Median of the positive values of the days before each day, and how many there are."""
    w = Window.partitionBy(*keys).orderBy("ds").rowsBetween(-days, -1)
    positive = F.when(F.col("y") > 0, F.col("y"))
    rows = panel.select(*keys, "ds", F.sort_array(F.collect_list(positive).over(w)).alias("seen")).withColumn("n_points", F.size("seen").cast("long"))
    low, high = (F.element_at("seen", F.expr(f"CAST((n_points + {k}) DIV 2 AS INT)")) for k in (1, 2))
    return rows.select(*keys, "ds", F.when(F.col("n_points") > 0, (low + high) / 2).alias("reference"), "n_points")


def initial_levels(days: DataFrame, warmup_days: int = 28) -> DataFrame:
    """Median of a leaf's positive sales in its first calendar days."""
    keys = ["section", "store", "sku"]
    first = F.min("ds").over(Window.partitionBy(*keys))
    warm = days.withColumn("first_ds", first).where(F.date_diff("ds", "first_ds") < warmup_days)
    positive = F.when(F.col("y") > 0, F.col("y"))
    return warm.groupBy(*keys).agg(F.coalesce(F.median(positive), F.lit(0.0)).alias("initial_level"), F.count(positive).alias("warmup_positive_days"))
