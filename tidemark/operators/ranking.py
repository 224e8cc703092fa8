"""Rankings, top lists, navigation and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Cohorts
from tidemark.functions.exprs import clip, display_label, ratio_or_zero, unique_id
from tidemark.sources.stage import stage


def ranked(metrics: DataFrame, within: list[str], ids: list[str]) -> DataFrame:
    """rank by wMAPE (nulls last), ties by ids; with each row's share of the group's error."""
    group = Window.partitionBy(*within)
    share = ratio_or_zero(F.col("sum_abs_error"), F.sum("sum_abs_error").over(group)) * 100
    order = group.orderBy(F.asc_nulls_last("wmape"), *ids)
    return metrics.withColumn("error_share", share).withColumn("rank", F.row_number().over(order).cast("long"))


def axis_ranking(metrics: DataFrame, axis: str, cohorts: Cohorts = Cohorts()) -> DataFrame:
    """Stores or SKUs of each section, out of sample; SKUs need enough days with sales to be ranked."""
    nodes = metrics.where((F.col("level") == axis) & (F.col("period_type") == "out_sample"))
    if axis == "sku":
        nodes = nodes.where(F.col("n_with_sales") >= cohorts.ranking_days)
    return ranked(nodes, ["section"], [axis])


def placed(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """One dense order over all rows without bringing them to one task: range partitions, the rows before each of them, and a row's place inside its own."""
    ranged = stage(df.repartitionByRange(*order).withColumn("range_part", F.spark_partition_id()))
    counts = ranged.groupBy("range_part").count().withColumnRenamed("range_part", "part_id")  # a row a partition
    before = counts.select("part_id", F.coalesce(F.sum("count").over(Window.orderBy("part_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("rows_before"))
    inside = F.row_number().over(Window.partitionBy("range_part").orderBy(*order))
    out = ranged.withColumn("place_inside", inside).join(before, F.col("range_part") == F.col("part_id"))
    return out.withColumn(name, (F.col("place_inside") + F.col("rows_before")).cast("long")).drop("range_part", "part_id", "place_inside", "rows_before")


def global_leaf_ranking(metrics: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """All leaves out of sample in one dense order (units of measure)."""
    leaves = metrics.where((F.col("level") == "leaf") & (F.col("period_type") == "out_sample")).withColumn("unidad", F.lit("units"))
    out = placed(leaves, [F.asc_nulls_last("wmape"), F.asc("section"), F.asc("store"), F.asc("sku")])
    return out.join(labels, "sku", "left") if labels is not None else out


def pinned(ranking: DataFrame, axis: str, selected: str | None, days: DataFrame) -> DataFrame:
    """A ranking with the selected row first and each row's coverage: days with sales in percent of its section's days."""
    spine = days.groupBy("section").agg(F.count_distinct("ds").alias("spine_days"))
    out = ranking.join(spine, "section", "left").withColumn("coverage", clip(ratio_or_zero(F.col("n_with_sales").cast("double"), F.col("spine_days").cast("double")) * 100, 0.0, 100.0))
    return out.withColumn("selected", F.col(axis).eqNullSafe(F.lit(selected))).orderBy("section", F.desc("selected"), "rank")


def top_per_group(df: DataFrame, keys: list[str], n: int, *order) -> DataFrame:
    return df.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("position") <= n)


def best_per_key(df: DataFrame, keys: list[str], *order) -> DataFrame:
    return top_per_group(df, keys, 1, *order).drop("position")


def navigation(days: DataFrame) -> DataFrame:
    """Sorted stores and SKUs of each section."""
    return days.groupBy("section").agg(F.sort_array(F.collect_set("store")).alias("stores"), F.sort_array(F.collect_set("sku")).alias("skus"))


def related(days: DataFrame, of: str, to: str) -> DataFrame:
    """For each value of one axis the values of the other that it is seen with."""
    return days.select("section", of, to).distinct().orderBy("section", of, to)


def labels(nodes: DataFrame) -> DataFrame:
    return nodes.select(unique_id().alias("unique_id"), display_label(F.col("section"), F.col("store"), F.col("sku")).alias("label")).distinct()


def non_active_leaves(cohorts: DataFrame) -> DataFrame:
    return cohorts.where(F.col("metric_cohort") != "active")


def sample_series(days: DataFrame, n: int) -> DataFrame:
    """A fixed choice of n leaves for debugging; a sampling operator, so it has a limit."""
    keys = ["section", "store", "sku"]
    chosen = days.select(*keys).distinct().orderBy(F.xxhash64(*keys), *keys).limit(n)
    return days.join(chosen, keys, "left_semi")


def sample_nodes(series: DataFrame, n: int) -> DataFrame:
    """The same choice from a table that also holds the leaves' parents (null store or SKU): parents of chosen leaves stay whole."""
    leaves = series.where("store IS NOT NULL AND sku IS NOT NULL")
    chosen = leaves.select("section", "store", "sku").distinct().orderBy(F.xxhash64("section", "store", "sku"), "section", "store", "sku").limit(n)
    kept = chosen.unionByName(chosen.select("section", "store").distinct(), allowMissingColumns=True).unionByName(chosen.select("section").distinct(), allowMissingColumns=True)
    same = [series[c].eqNullSafe(kept[c]) for c in ("section", "store", "sku")]
    return series.join(kept, same[0] & same[1] & same[2], "left_semi")
