"""Closed-block updates as a stream: state moves on only when a block is closed, and windows of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_windows(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling counts and sums of events; works on batch and stream alike."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    return rows.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def smooth_closed_blocks(blocks: DataFrame, alpha: float = 0.1) -> DataFrame:
    """Level per leaf after each closed block (leaf, block, y): a keyed state that a micro-batch per block moves on."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def advance(key, frames, state):
        level = state.get[0] if state.exists else None
        # A key's rows of one micro-batch (its closed blocks) may come in several frames: their order holds over all of them.
        whole = pd.concat([frame[["block", "y"]] for frame in frames], ignore_index=True).sort_values("block")
        out = []
        for block, y in whole.itertuples(index=False):
            out.append((key[0], int(block), float("nan") if level is None else level))
            if y > 0:
                level = float(y) if level is None else alpha * float(y) + (1 - alpha) * level
        if level is not None:
            state.update((level,))
        yield pd.DataFrame(out, columns=["leaf", "block", "level_before"])

    return blocks.groupBy("leaf").applyInPandasWithState(advance, "leaf string, block long, level_before double", "level double", "append", GroupStateTimeout.NoTimeout)
