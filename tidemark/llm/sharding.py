"""Contiguous balanced shards by global byte-size prefix sums.

Rows get one global order (a 64-bit hash of the text, then the id), so equal texts stand side by
side. Each range partition is summed, the per-partition totals become prefix sums, and a running
sum inside each partition gives every row the byte position at which it starts. Shard k holds the
rows whose middle byte lies in the k-th of equal parts of all bytes: shards are contiguous in the order and
differ from the equal target by less than a row at each cut. Only ids, sizes and hashes are
shuffled, never texts. A large group of equal texts is spread over partitions since the id is part
of the order, and cut where a target falls inside it.

Null text: size 1 (no bytes plus one) and the hash and CRC of the empty text. Empty table: no rows.
Repeated rows (same id and text) are rows of their own, side by side. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import cut, documents, narrow


def with_prefix_sums(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Adds `before` (sum of size over earlier rows in order) and `place` (number of earlier rows)."""
    ranged = cut(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum(size).alias("part_size"), F.count(F.lit(1)).alias("part_rows"))
    # One row a partition: their number follows the cluster's partitioning, not the rows in them.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("part").alias("part_id"),
        F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    offsets = {r["part_id"]: (r["size_before"], r["rows_before"]) for r in totals.collect()}
    schema = ranged.drop("part").schema.add("before", "long").add("place", "long")
    names = [f.name for f in schema.fields]

    def running(batches):
        import pyarrow as pa

        done_size = done_rows = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if done_size is None:
                done_size, done_rows = offsets[batch.column("part")[0].as_py()]
            sizes = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            before = done_size + np.cumsum(sizes) - sizes
            place = done_rows + np.arange(len(sizes), dtype=np.int64)
            done_size, done_rows = done_size + int(sizes.sum()), done_rows + len(sizes)
            columns = {**{n: batch.column(n) for n in names[:-2]}, "before": pa.array(before), "place": pa.array(place)}
            yield pa.RecordBatch.from_pydict(columns)

    return ranged.sortWithinPartitions(*order).mapInArrow(running, schema)


def shard_table(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard, slot: `shards` contiguous shards of nearly equal bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = narrow(docs, id_col, text_col).toDF("id", "text")
    rows = rows.select("id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    placed = cut(with_prefix_sums(rows, ["text_hash", "id"], "size"))
    total = placed.agg(F.max(F.col("before") + F.col("size")).alias("n")).first()["n"] or 1
    shard = F.least(F.floor((F.col("before") + F.col("size") / 2) * shards / F.lit(total)), F.lit(shards - 1)).cast("int")
    placed = placed.withColumn("shard", shard)
    starts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))  # one row a shard
    return placed.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )


def op8_sharding(spark, sf_dir):
    return shard_table(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
