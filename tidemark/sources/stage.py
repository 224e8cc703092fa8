"""Stages: tables written once in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stage_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where the session names none, a folder of this machine in local mode, an error elsewhere."""
    context = spark.sparkContext
    set_already = context._jsc.sc().getCheckpointDir()
    found = set_already.get() if set_already.isDefined() else context.getConf().get("spark.checkpoint.dir")
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        found = "file://" + tempfile.mkdtemp(prefix="tidemark-stage-")
    if not set_already.isDefined():
        context.setCheckpointDir(found)
    return found


def stage(df: DataFrame) -> DataFrame:
    """Computed once and kept outside the executors, so that the plans behind it read a table, not the facts again."""
    stage_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key in one task, over a number of tasks that the adaptive plan doesn't lower: for grouped Python work, which costs far more than its bytes tell."""
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)
