"""Readers and writers: raw sales and catalogue files, Parquet stages, serving partitions, manifests."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

# Positional columns of the raw files.
SALES_COLUMNS = ["SALES_DATE", "SKU_ID", "STORE_ID", "TRAN_TYPE", "SLS_VAL", "SLS_QTY", "RTRN_QTY", "RTRN_VAL"]
MASTER_COLUMNS = ["SKU", "DESCRIPCION", "SECCION", "CLASIFICACION", "CATEGORIA", "DESC_CATEGORIA", "SUBCATEGORIA", "DESC_SUBCATEGORIA", "FAMILIA", "DESC_FAMILIA", "SUBFAMILIA", "DESC_SUBFAMILIA"]
NUMERIC = ["SLS_VAL", "SLS_QTY", "RTRN_QTY", "RTRN_VAL"]
# What code page 1252 has in bytes 128 to 159 (0 where it has nothing).
CP1252 = [8364, 0, 8218, 402, 8222, 8230, 8224, 8225, 710, 8240, 352, 8249, 338, 0, 381, 0, 0, 8216, 8217, 8220, 8221, 8226, 8211, 8212, 732, 8482, 353, 8250, 339, 0, 382, 376]

SALES_SCHEMA = StructType([StructField("SALES_DATE", TimestampNTZType()), *(StructField(c, StringType()) for c in SALES_COLUMNS[1:4]), *(StructField(c, DoubleType()) for c in NUMERIC)])


def cp1252(c):
    """Latin-1 text, read from code page 1252, put right."""
    pairs = [(chr(128 + i), chr(k)) for i, k in enumerate(CP1252) if k]
    return F.translate(c, "".join(a for a, _ in pairs), "".join(b for _, b in pairs))


def required(df: DataFrame, names: list[str]) -> DataFrame:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_pipe(spark: SparkSession, path, names: list[str]) -> DataFrame:
    """Pipe-separated text without header or quotes, all strings; short rows get nulls, long rows are cut."""
    raw = spark.read.option("quote", "").option("mode", "PERMISSIVE").csv(path, sep="|", header=False, encoding="ISO-8859-1", schema=", ".join(f"`{n}` string" for n in names))
    return raw.select(*(F.trim(cp1252(F.col(n))).alias(n) for n in names))


def read_master(spark: SparkSession, path, sections: list[str] | None = None) -> DataFrame:
    out = read_pipe(spark, path, MASTER_COLUMNS).where(F.col("SKU") != "SKU").distinct()
    return out.where(F.col("SECCION").isin(sections)) if sections else out


def read_sales(spark: SparkSession, path, keep_duplicates: bool = False) -> DataFrame:
    """Typed sales of a path, list or glob; equal transactions collapse unless kept. Unreadable values become null."""
    raw = read_pipe(spark, path, SALES_COLUMNS)
    out = raw.select(
        F.try_to_timestamp("SALES_DATE", F.lit("dd-MM-yyyy HH:mm:ss")).cast("timestamp_ntz").alias("SALES_DATE"),
        "SKU_ID", "STORE_ID", "TRAN_TYPE",
        *(F.col(c).try_cast("double").alias(c) for c in NUMERIC),
    )
    return out if keep_duplicates else out.distinct()


def empty_sales(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SALES_SCHEMA)


def select_sales(sales: DataFrame, master: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Positive sales of known SKUs in allowed (SECCION, STORE_ID) pairs; one catalogue row per SKU."""
    required(sales, SALES_COLUMNS[:6])
    required(master, ["SKU", "SECCION", "DESCRIPCION"])
    descriptions = [c for c in ("SECCION", "DESCRIPCION", "DESC_CATEGORIA", "DESC_SUBCATEGORIA", "DESC_FAMILIA", "DESC_SUBFAMILIA") if c in master.columns]
    one = master.groupBy("SKU").agg(F.min(F.struct(*descriptions)).alias("m")).select("SKU", "m.*")
    out = sales.where((F.col("SLS_VAL") > 0) | (F.col("SLS_QTY") > 0)).withColumn("SALES_DAY", F.to_date("SALES_DATE"))
    out = out.join(one, out["SKU_ID"] == one["SKU"]).drop("SKU")
    return out.join(allowed.select("SECCION", "STORE_ID").distinct(), ["SECCION", "STORE_ID"], "left_semi") if allowed is not None else out


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV or Parquet table by its name."""
    return spark.read.csv(path, header=True, inferSchema=True) if path.lower().endswith(".csv") else spark.read.parquet(path)


def save(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def save_series(df: DataFrame, path: str, block_bytes: int = 1 << 20) -> None:
    """Serving series: a folder a section, sorted, in small row groups. Large sections are spread by id."""
    dealt = df.repartitionByRange("section", "unique_id").sortWithinPartitions("section", "unique_id", "ds")
    dealt.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", block_bytes).partitionBy("section").parquet(path)


def load_series(spark: SparkSession, path: str, section: str, unique_ids: list[str]) -> DataFrame:
    """Series of some ids: one folder and pushed-down ids."""
    return spark.read.option("recursiveFileLookup", "false").parquet(path).where((F.col("section").cast("string") == section) & F.col("unique_id").isin(unique_ids))


def save_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def load_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def save_export(df: DataFrame, path: str) -> None:
    """A small aggregated table as one CSV with header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table: no column is read, the footers' counts are added up."""
    return spark.read.parquet(path).count()


def source_fingerprint(spark: SparkSession, path: str, version: int = 1) -> dict:
    """fingerprint() of a table in any store that Spark reads: latest change, size and rows of its files."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    latest, size = 0, 0
    while found.hasNext():  # an entry a file, on the driver
        status = found.next()
        if not status.getPath().getName().startswith(("_", ".")):
            latest, size = max(latest, status.getModificationTime()), size + status.getLen()
    return {"mtime": latest, "size": size, "version": version, "rows": row_count(spark, path)}


# --- manifests (small driver files) ------------------------------------------------------------


def write_manifest(path: str, **state) -> None:
    with open(path + ".tmp", "w", encoding="utf-8") as f:
        json.dump(state, f, sort_keys=True)
    os.replace(path + ".tmp", path)


def read_manifest(path: str) -> dict | None:
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return None


def fingerprint(path: str, version: int = 1, rows: int | None = None) -> dict:
    names = [os.path.join(d, n) for d, _, files in os.walk(path) for n in files] if os.path.isdir(path) else [path]
    stats = [os.stat(n) for n in sorted(names)]
    return {"mtime": max(s.st_mtime_ns for s in stats), "size": sum(s.st_size for s in stats), "version": version, "rows": rows}


def stale_reasons(manifest: dict | None, source: str, version: int = 1, spark: SparkSession | None = None) -> list[str]:
    """Why a result isn't usable; empty if it is. With a session the source may lie in any store, and its rows are counted."""
    if manifest is None:
        return ["no manifest"]
    out = [] if manifest.get("status") == "success" else [f"status is {manifest.get('status')}"]
    now = source_fingerprint(spark, source, version) if spark else fingerprint(source, version, (manifest.get("source") or {}).get("rows"))
    return out + ([] if manifest.get("source") == now else ["source has changed"])


def ready_cadences(manifests: dict[int, dict | None], source: str, spark: SparkSession | None = None) -> list[int]:
    """The cadences whose results may be offered: there, finished and of this source."""
    return sorted(c for c, m in manifests.items() if not stale_reasons(m, source, spark=spark))


def ensure_selected(selected: str, have_raw: bool, have_ingested: bool, rebuild_selection, rebuild_all) -> str:
    """Reuse the selection, rebuild it from ingested tables, rebuild everything from raw files, or fail."""
    if os.path.exists(selected):
        return "reused"
    if have_ingested:
        rebuild_selection()
        return "selection rebuilt"
    if have_raw:
        rebuild_all()
        return "all rebuilt"
    raise FileNotFoundError(selected)
