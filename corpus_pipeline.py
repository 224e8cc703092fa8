"""The corpus pipeline: stages over `documents`, each written as Parquet and read again for the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last keep the columns
of `documents`; the last returns one row per packed piece. Rows without an id are never grouped, so
they pass the third stage; of rows with one id and text one stays there, and rows with one id and
different texts are documents of their own. An empty document passes the fourth stage and packs as
its end token, but the second rejects it. An empty table has no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import cotraining, jaccard_join, packing, quality_rules, suffix_dedup
from tidemark.llm.scratch import drop, store
from tidemark.llm.textkit import cut


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (4): rejected documents go."""
    return cotraining.keep_good(docs, labels_of(spark, sf_dir))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (3): rejected documents go."""
    return quality_rules.keep_good(docs, labels_of(spark, sf_dir))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (1): of each group the document with the smallest id stays."""
    return jaccard_join.one_of_each_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup (7): repeated 200-byte windows leave the texts."""
    return suffix_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing (9): one row per piece."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack),
]

#: SQL can't express the classifier, the radix passes or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        out, written = store(stage(spark, docs, sf_dir))
        if path:
            drop(spark, path)
        docs, path = out, written
    packed = cut(STAGES[-1][1](spark, docs, sf_dir))
    drop(spark, path)
    return packed
