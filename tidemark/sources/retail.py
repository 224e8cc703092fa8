"""The retail view of the star-schema tables: sections, stores, SKUs, days, units and money.

Money is kept in 1/64 units and naive forecasts in 1/16 units, so that sums of doubles are exact
and don't depend on the order in which a cluster adds them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import Horizon

LEAF = ["section", "store", "sku"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a transaction. Dimensions join as Catalyst sees fit by their size."""
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    stores = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    joined = line.join(stores, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("n_regionkey").cast("string").alias("section"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("store"),
        F.col("p_brand").alias("sku"),
        F.to_date("l_shipdate").alias("ds"),
        F.col("l_quantity").alias("y"),
        (F.bround(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 64, 0) / 64).alias("value"),
        F.col("l_returnflag").alias("tran_type"),
        F.col("n_name").alias("store_name"),
        F.col("p_name").alias("sku_desc"),
    )


def leaf_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).groupBy(*LEAF, "ds").agg(F.sum("y").alias("y"), F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"))


def section_bounds(days: DataFrame) -> DataFrame:
    """First and last day of each section, from leaf days or from the facts."""
    return days.groupBy("section").agg(F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))


def with_blocks(days: DataFrame, bounds: DataFrame | None = None, horizon: Horizon = Horizon()) -> DataFrame:
    """Adds k: 0 for the last block of a section's days, 1 for the one before, and so on."""
    bounds = section_bounds(days) if bounds is None else bounds
    return days.join(bounds, "section").withColumn("k", F.floor(F.date_diff("last_ds", "ds") / horizon.block_days))


def naive_forecast(days: DataFrame, bounds: DataFrame | None = None, horizon: Horizon = Horizon()) -> DataFrame:
    """All leaf days with a causal forecast: the block before, spread evenly over its days (0 where it had no sales).

    The block before is a window over the leaf's own rows, so history is neither joined to itself nor cut."""
    before = Window.partitionBy(*LEAF).orderBy("k").rangeBetween(1, 1)

    def even(c):
        return F.bround(F.coalesce(F.sum(c).over(before), F.lit(0.0)) / horizon.block_days * 16, 0) / 16

    return with_blocks(days, bounds, horizon).select(
        *LEAF, "ds", "k", "y", "value", even("y").alias("yhat"), even("value").alias("valuehat"),
        F.when(F.col("k") == 0, "out_sample").otherwise("in_sample").alias("period_type"),
    )


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounds come from two columns of the facts, not from a second aggregation of the leaf days."""
    return naive_forecast(leaf_days(spark, sf_dir), section_bounds(facts(spark, sf_dir)))


def first_in_group(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each group in a total order."""
    ranked = df.withColumn("row_in_group", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("row_in_group = 1").drop("row_in_group")
