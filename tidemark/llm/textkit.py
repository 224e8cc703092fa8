"""Vectorised text work on Arrow batches, shared by the operators of this folder.

Texts stay the UTF-8 bytes that Arrow holds; words, their 64-bit hashes and windows are found by
NumPy passes over those bytes, in chunks of whole documents, so that memory follows the chunk
and no Python object is made per word. Null texts are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 19
BATCH_ROWS = "2000"
DEFAULT_BATCH_ROWS = "10000"
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)

#: Bytes between words: space and the control characters 9 to 13.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = _IDENTITY.copy()
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit values (the public splitmix64 step)."""
    h = np.asarray(h, dtype=np.uint64).copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        full = np.full(size, base, dtype=np.uint64)
        full[0] = 1
        have = np.cumprod(full, dtype=np.uint64)
        if size <= 8 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, and where each begins (one more entry than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about `limit` bytes: first, end, their bytes and offsets from 0."""
    first, count = 0, len(offsets) - 1
    while first < count:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), count)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and each document's first word (one more entry than documents)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = ~separators[data]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begin[edges] = inside[edges]
    finish[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; span_hash() takes any span from it."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers(_MULTIPLIER, len(data)), out=out[1:])
    return out


def span_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans' bytes, wherever they stand."""
    h = (running[ends] - running[starts]) * powers(_INVERSE, len(running))[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and each document's first word."""
    starts, ends, first = find_words(data, offsets, separators)
    return span_hash(prefix_hash(data), starts, ends), first


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; meaningful only where n words are left."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        out += words[k : k + count] * np.uint64(pow(_MULTIPLIER, k + 1, 1 << 64))
    return mix(out)


# --- Spark side -----------------------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Rows of whole texts go to Python in batches of BATCH_ROWS, not of Spark's default number, so that memory on both sides follows fewer texts; a session's own setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == DEFAULT_BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def narrow(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, by exact name, so that extra columns of any name do no harm; their rows go to Python in bounded batches."""
    bounded_batches(df.sparkSession)
    return df.select(*(F.col(f"`{n}`") for n in names))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; where the session names none, a folder of this machine in local mode, an error elsewhere."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or (context._jsc.sc().getCheckpointDir().get() if context._jsc.sc().getCheckpointDir().isDefined() else None)
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        found = "file://" + tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        context.setCheckpointDir(found)
    elif not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Checkpoints a table in the shared folder: computed once, and kept if executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
