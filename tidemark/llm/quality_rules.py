"""Quality rules: page rules, and a hashed n-gram log-likelihood ratio between trusted texts and the corpus.

Words and neighbouring word pairs of every text are hashed into BUCKETS counters. They are counted
over the whole corpus and over trusted texts (all that are named, or the TRUSTED of them with the
smallest hash of their id, if there are more: the sample is of labelled rows and bounded).
A bucket's weight is

    log((trusted count + prior) / (expected trusted count + prior)),

the expected count being the bucket's count in the corpus times the trusted texts' share of all
n-grams, and the prior PRIOR or, if that is more, PRIOR_SHARE of the trusted n-grams. A text's score
is the mean weight of its n-grams; texts at or above THRESHOLD are kept unless a page rule fails.

The prior is a share of the trusted n-grams so that weights depend on how large a part of either
side an n-gram makes up, which doesn't change with the corpus's size. Nor does what a bucket's other
n-grams add to it: rare n-grams, however many kinds of them there are, spread evenly, so a bucket
holds about 1 / BUCKETS of either side in them, an eighth of the prior. So the table has one size
for all corpora, and it is broadcast (BUCKETS * 4 bytes). Every task counts all its texts into such
a table and sends it in slices, packed; a slice is added up in one task, at most one row a task.

Nothing is sampled but the trusted texts, and equal texts get equal verdicts. Null and empty texts:
no words, score 0, base_failed. Without trusted texts all weights are 0. Repeated rows count and
come back as often as they came. Empty table: no rows. Extra columns are ignored by the query and
kept by keep_good().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .scratch import drop, store
from .textkit import SPACE, buffers, chunks, documents, find_words, gram_hashes, mix, narrow, prefix_hash, span_hash

BUCKETS = 1 << 22
SLICE_BITS = 14
TRUSTED = 50_000
PRIOR = 5.0
PRIOR_SHARE = 8 / BUCKETS
THRESHOLD = -0.2
REPEAT_WINDOW = 8

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE_END = np.zeros(256, dtype=bool)
_LINE_END[0x0A] = True


def per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return running[offsets[1:]] - running[offsets[:-1]]


def page_facts(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The page rules' columns, word hashes, and each document's first word."""
    docs = len(offsets) - 1
    starts, ends, first = find_words(data, offsets)
    running = prefix_hash(data)
    words = span_hash(running, starts, ends)
    inside = ~SPACE[data]
    facts = {
        "n_words": np.diff(first),
        "word_chars": per_document(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_document(_SYMBOL[data], offsets),
    }
    a, b, first_line = find_words(data, offsets, _LINE_END)
    held = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    doc = np.repeat(np.arange(docs), np.diff(first_line))
    full = held[b] > held[a]
    doc = doc[full]
    key = mix(span_hash(running, a[full], b[full]) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # A line's first standing is not a repeat, so repeats are lines less distinct lines.
    _, distinct = np.unique(key, return_index=True)
    facts["n_dup_lines"] = np.bincount(doc, minlength=docs) - np.bincount(doc[distinct], minlength=docs)
    facts["n_repeat_words"] = repeat_words(words, first, docs)
    return facts, words, first


def repeat_words(words: np.ndarray, first: np.ndarray, docs: int, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Words inside windows of `width` words that the document holds twice or more."""
    out = np.zeros(docs, dtype=np.int64)
    grams = gram_hashes(words, width)
    doc = np.repeat(np.arange(docs), np.diff(first))
    if not len(grams):
        return out
    own = np.flatnonzero(doc[: len(grams)] == doc[width - 1 :])
    key = mix(grams[own] + doc[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    if not same.any():
        return out
    twice = np.zeros(len(key), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = own[order[twice]]
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.bincount(doc, weights=np.cumsum(edge[:-1]) > 0, minlength=docs).astype(np.int64)


def base_failed(facts: dict[str, np.ndarray]) -> np.ndarray:
    return (facts["n_words"] < 20) | (100 * facts["n_repeat_words"] > 30 * facts["n_words"])


def gram_buckets(words: np.ndarray, first: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of every word and word pair."""
    docs = len(first) - 1
    doc = np.repeat(np.arange(docs), np.diff(first))
    pairs = gram_hashes(words, 2)
    own = doc[: len(pairs)] == doc[1:] if len(pairs) else np.zeros(0, bool)
    both = np.concatenate([words, pairs[own]]) >> np.uint64(13)
    return (both % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, doc[: len(pairs)][own]])


def trusted_ids(labels: DataFrame, limit: int = TRUSTED) -> list:
    good = labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return [r[0] for r in good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()]


def planes(values: np.ndarray) -> bytes:
    """32-bit values by bytes: all lowest bytes first, so that small values compress well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def gram_counts(rows: DataFrame, trusted: list, buckets: int) -> DataFrame:
    """slice, raw, good: 64-bit counts of each slice of buckets over all rows (id, text) and over the trusted ones."""
    named = rows.sparkSession.sparkContext.broadcast(set(trusted))  # TRUSTED ids at most
    width = min(buckets, 1 << SLICE_BITS)

    def run(batches):
        raw, good = np.zeros(buckets, dtype=np.uint32), np.zeros(buckets, dtype=np.uint32)
        for batch in batches:
            is_good = np.asarray([i in named.value for i in batch.column(0).to_pylist()], dtype=bool)
            data, offsets = buffers(batch.column(1))
            for start, end, part, at in chunks(data, offsets):
                a, b, first = find_words(part, at)
                bucket, doc = gram_buckets(span_hash(prefix_hash(part), a, b), first, buckets)
                np.add.at(raw, bucket, np.uint32(1))
                if is_good[start:end].any():
                    np.add.at(good, bucket[is_good[start:end][doc]], np.uint32(1))
        for number in range(buckets // width):
            mine = slice(number * width, (number + 1) * width)
            used = np.flatnonzero(raw[mine])
            if len(used):
                blobs = (planes(np.diff(used, prepend=0)), planes(raw[mine][used]), planes(good[mine][used]))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], names=["slice", "places", "raw", "good"])

    def add_up(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for batch in batches:
            for places, n, g in zip(*(batch.column(c) for c in ("places", "raw", "good"))):
                at = np.cumsum(from_planes(places.as_py()))
                raw[at] += from_planes(n.as_py())
                good[at] += from_planes(g.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([int(raw.sum())]), pa.array([int(good.sum())]), *(pa.array([x.tobytes()], pa.binary()) for x in (raw, good))], names=["slice", "raw_total", "good_total", "raw", "good"])

    packed = rows.mapInArrow(run, "slice int, places binary, raw binary, good binary")
    return packed.groupBy("slice").applyInArrow(add_up, "slice int, raw_total long, good_total long, raw binary, good binary")


def ratio_weights(rows: DataFrame, trusted: list, buckets: int = BUCKETS) -> np.ndarray:
    """Weight of each bucket from counts over all rows (id, text) and over the trusted ones."""
    counts, path = store(gram_counts(rows, trusted, buckets))
    raw_total, good_total = (x or 0 for x in counts.agg(F.sum("raw_total"), F.sum("good_total")).first())
    out = np.zeros(buckets, dtype=np.float32)
    if good_total:
        share, prior = good_total / raw_total, max(PRIOR, PRIOR_SHARE * good_total)

        def weigh(batches):
            for batch in batches:
                weights = []
                for raw, good in zip(batch.column(1), batch.column(2)):
                    raw, good = np.frombuffer(raw.as_buffer(), np.int64), np.frombuffer(good.as_buffer(), np.int64)
                    weights.append(np.log((good + prior) / (raw * share + prior)).astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights, pa.binary())], names=["slice", "weights"])

        found = counts.select("slice", "raw", "good").mapInArrow(weigh, "slice int, weights binary").toArrow()  # `buckets` numbers in all
        for number, weights in zip(found.column("slice").to_pylist(), found.column("weights")):
            values = np.frombuffer(weights.as_buffer(), "<f4")
            out[number * len(values) : (number + 1) * len(values)] = values
    drop(rows.sparkSession, path)
    return out


FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, text_col: str = "text", with_text: bool = True) -> DataFrame:
    """All columns of `docs`, then the page rules' columns, base_failed, kept and ratio."""
    names = docs.columns
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))
    where = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = StructType(list(rows.schema.fields))
    for n in FACTS:
        schema = schema.add(f"f_{n}", "long")
    schema = schema.add("f_base_failed", "boolean").add("f_kept", "boolean").add("f_ratio", "double")

    def run(batches):
        table = shared.value
        for batch in batches:
            data, offsets = buffers(batch.column(where))
            for start, end, part, at in chunks(data, offsets):
                facts, words, first = page_facts(part, at)
                bucket, doc = gram_buckets(words, first, len(table))
                n = np.bincount(doc, minlength=end - start)
                ratio = np.bincount(doc, weights=table[bucket], minlength=end - start) / np.maximum(n, 1)
                failed = base_failed(facts)
                columns = batch.slice(start, end - start).columns
                if not with_text:
                    columns[where] = pa.nulls(end - start, columns[where].type)
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(facts[k].astype(np.int64)) for k in FACTS), pa.array(failed), pa.array(~failed & (ratio >= threshold)), pa.array(ratio)], names=schema.names)

    return rows.mapInArrow(run, schema)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, with_text: bool = True) -> DataFrame:
    """judged() with weights of this corpus; without `with_text` the text's column is null."""
    weights = ratio_weights(narrow(docs, "doc_id", "text"), trusted_ids(labels), buckets)
    return judged(docs, weights, threshold, with_text=with_text)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with their columns."""
    return judge(docs, labels).where("f_kept").select(*(f"c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


def op3_quality_rules(spark, sf_dir):
    out = judge(narrow(documents(spark, sf_dir), "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"), with_text=False)
    return out.select(F.col("c0").alias("doc_id"), *(F.col(f"f_{n}").alias(n) for n in FACTS), F.col("f_base_failed").alias("base_failed"), F.col("f_kept").alias("kept"), F.col("f_ratio").alias("ratio"))
