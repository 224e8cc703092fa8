"""Price decomposition by native windows, and causal price carry-forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Price


def decompose(series: DataFrame, keys: list[str], price: Price = Price()) -> DataFrame:
    """asp, edp and discount of each row in date order.

    edp is the forward minimum over `window` rows of the trailing maximum of asp; the first rows
    take the trailing maximum of row window (or of the last row of a shorter series, where it is 0).
    """
    n = price.window
    w = Window.partitionBy(*keys).orderBy("ds")
    whole = Window.partitionBy(*keys)
    out = series.withColumn("asp", F.when(F.col("y") > 0, F.col("value") / F.when(F.col("y") > 0, F.col("y"))).otherwise(F.lit(0.0)))
    out = out.withColumn("i", F.row_number().over(w) - 1).withColumn("rows", F.count(F.lit(1)).over(whole))
    trailing = F.when(F.col("i") >= n - 1, F.max("asp").over(w.rowsBetween(-(n - 1), 0))).otherwise(F.lit(0.0))
    out = out.withColumn("trailing", trailing)
    head = F.max(F.when(F.col("i") == F.least(F.lit(n), F.col("rows")) - 1, F.col("trailing"))).over(whole)
    out = out.withColumn("lookback", F.when(F.col("i") < n - 1, head).otherwise(F.col("trailing")))
    out = out.withColumn("edp", F.min("lookback").over(w.rowsBetween(0, n - 1)))
    discount = F.when(F.col("edp") > 0, 1 - F.col("asp") / F.when(F.col("edp") > 0, F.col("edp"))).otherwise(F.lit(0.0))
    return out.withColumn("discount", discount).drop("i", "rows", "trailing", "lookback")


def quick_decompose(series: DataFrame) -> DataFrame:
    """Approximation for very many series: asp = edp, no discount."""
    asp = F.col("value") / F.greatest(F.col("y"), F.lit(1e-8))
    return series.withColumn("asp", asp).withColumn("edp", asp).withColumn("discount", F.lit(0.0))


def last_prices(priced: DataFrame, keys: list[str]) -> DataFrame:
    """The last known price of each key, to carry into days that have none."""
    return priced.groupBy(*keys).agg(F.max_by(F.struct("asp", "edp", "discount"), "ds").alias("p"), F.max("ds").alias("price_ds")).select(*keys, "price_ds", "p.*")


def add_leaf_edp(series: DataFrame, keys: list[str]) -> DataFrame:
    """Leaf price diagnostic: the decomposition, with prices of days without sales carried forward."""
    w = Window.partitionBy(*keys).orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    out = decompose(series, keys)
    return out.withColumn("edp_carried", F.last(F.when(F.col("edp") > 0, F.col("edp")), ignorenulls=True).over(w))
