"""Tables in the shared folder, and connected components over them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import cut, shared_dir


def store(df: DataFrame) -> tuple[DataFrame, str]:
    """Writes a table in the shared folder: computed once, columns prunable, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reached) of an undirected graph with columns a and b.

    Alternating large-star and small-star rounds; every round is one grouped minimum and one join,
    cut by a checkpoint, until the set of edges stands still. Self-links are dropped.
    """

    def stars(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(edges.select("b", "a")) if large else both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(lowest, "u")
        if large:
            out = out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(lowest.select("u", "m").toDF("a", "b"))
        return cut(out.where("a <> b").distinct())

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = cut(links.select("a", "b").where("a <> b").distinct())
    seen = None
    while (now := state(edges)) != seen:
        seen = now
        if not now[0]:
            break
        edges = stars(stars(edges, True), False)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return cut(nodes.union(edges.select("b", "b").distinct()))
