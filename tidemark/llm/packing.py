"""Best-fit packing of token sequences by bin completion with branch and bound.

Tokenising is a map over the documents; only piece lengths move after it. A length is at most the
capacity, so the whole corpus becomes a histogram of `capacity` counts, and the packing problem is
solved on that histogram, whatever the number of rows: the driver's part is bounded by the
capacity. Each solution step is a pattern (a filling around the largest length left) with the
number of sequences that it stands for.

Bin completion: take the largest length left, fill the room beside it as well as can be found, and
go on; that greedy solution is the incumbent. If it needs more sequences than the lower bound (ceil(sum / capacity),
or what lengths over half the capacity leave no room for), a
depth-first search branches over the undominated fillings of the largest length left (a filling is
dominated if a length that is left fits beside it, or can replace a smaller one in it) and over how
often each is taken, backtracks between sequences, and leaves a branch as soon as its waste exceeds
the slack of the number of sequences aimed at. The aim is the bound at first, then by bisection between
the bound and the incumbent. SEARCH_BUDGET nodes, and half as many for every further aim, bound the
search (packing is NP-hard); when they are used up the incumbent may stay above the optimum.

A piece is assigned by its rank among the pieces of equal length: ranks come from a count table
per (partition, length), and a pattern's ranges of ranks are looked up by bisection in a table
whose size depends on the capacity alone.

Null text: empty, so the document is its end token alone. A text that spells a special token holds
that token, as the library has it. Empty table: no rows. Repeated rows are packed as documents of
their own. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import cut, documents, narrow

CAPACITY = 1024
END_ID = 2
NODE_BUDGET = 4000
SEARCH_BUDGET = 200_000


class RankEncoder:
    """Ids of texts as little-endian 32-bit bytes, as `tokenizers` gives them without added special tokens.

    In a byte-level vocabulary file a merged piece's id grows with the rank of its merge, so the ids
    are the ranks of a byte-pair encoder, and `tiktoken`'s merge loop over them gives the very ids
    that the `tokenizers` library gives, at a fifth of its time (the tests hold one against the
    other). Texts that hold the string of an added token, which the library looks up before it
    splits words, and files of any other kind are encoded by `tokenizers` itself. With
    `special_as_text` the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = spec["model"].get("type", "BPE") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer")
        self.path, self.special_as_text = path, special_as_text
        self.encoding = self._ranks(spec) if plain else None
        self.added = [t["content"] for t in spec.get("added_tokens", []) if not (special_as_text and t.get("special"))]

    @functools.cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.encode_special_tokens = self.special_as_text
        return found

    @staticmethod
    def _ranks(spec: dict):
        import tiktoken
        from public_tokenizers import PATTERN

        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if self.encoding is None or any(t in text for t in self.added):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            else:
                ids = self.encoding.encode_ordinary(text)
            out.append(np.asarray(ids, dtype="<u4").tobytes())
        return out


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> RankEncoder:
    """One encoder a Python worker, kept over its tasks."""
    return RankEncoder(path)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32 of every piece; only documents over `capacity` are cut."""
    rows = narrow(docs, id_col, text_col).toDF("id", "text")
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def tokenise(batches):
        encoder = encoder_of(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                texts = [t or "" for t in part.column(1).to_pylist()]
                out = [], [], [], [], []
                for i, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    ids += end
                    n = len(ids) // 4
                    head = n % capacity or min(n, capacity)
                    begin, k = 0, 0
                    while begin < n:
                        length = head if k == 0 else capacity
                        for column, value in zip(out, (i, k, begin, length, zlib.crc32(ids[4 * begin : 4 * (begin + length)]))):
                            column.append(value)
                        begin, k = begin + length, k + 1
                yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])], names=["id", "piece", "start", "length", "ids_crc32"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tokenise, f"id {id_type}, piece int, start long, length long, ids_crc32 long")


def best_filling(room: int, counts: np.ndarray, top: int) -> list[int]:
    """Lengths (largest first, at most `top`) that fill `room` as well as can be found."""
    available = [s for s in range(min(room, top), 0, -1) if counts[s]]
    best: list[int] = []
    best_sum = 0
    nodes = 0
    smaller = np.zeros(room + 2, dtype=np.int64)  # largest length that is left and at most s
    last = 0
    for s in range(1, room + 1):
        if s < len(counts) and counts[s]:
            last = s
        smaller[s] = last

    used: dict[int, int] = {}
    chosen: list[int] = []

    def search(left: int, limit: int) -> bool:
        nonlocal best, best_sum, nodes
        nodes += 1
        total = room - left
        if total > best_sum:
            best, best_sum = chosen.copy(), total
            if best_sum == room:
                return True
        if nodes > NODE_BUDGET:
            return True
        s = int(smaller[min(left, limit)])
        tried = 0
        while s > 0 and tried < 24:
            if used.get(s, 0) < counts[s]:
                tried += 1
                used[s] = used.get(s, 0) + 1
                chosen.append(s)
                done = search(left - s, s)
                chosen.pop()
                used[s] -= 1
                if done:
                    return True
            s = int(smaller[s - 1])
        return False

    if available:
        search(room, min(room, top))
    return best


def fillings(room: int, counts: np.ndarray, top: int, slack: int, nodes: list[int]):
    """All undominated fillings of `room` by lengths up to `top` with a waste of `slack` at most, larger lengths first."""
    sizes = [s for s in np.flatnonzero(counts[: min(room, top) + 1]).tolist()[::-1] if s]
    left_of = {s: int(counts[s]) for s in sizes}
    below = [0] * (len(sizes) + 1)  # sum of all lengths from a place on
    for i in range(len(sizes) - 1, -1, -1):
        below[i] = below[i + 1] + sizes[i] * left_of[sizes[i]]
    chosen: list[int] = []

    def undominated(waste: int) -> bool:
        spare = [s for s in sizes if left_of[s]]
        if spare and spare[-1] <= waste:
            return False
        return not any(s < t <= s + waste for s in set(chosen) for t in spare)

    stack = [(0, room, -1)]  # place, room left, length to give back when the branch is done
    while stack:
        i, left, back = stack.pop()
        if i < 0:
            left_of[back] += 1
            chosen.pop()
            continue
        if back > 0:
            chosen.append(back)
            left_of[back] -= 1
            stack.append((-1, 0, back))
        nodes[0] -= 1
        if nodes[0] <= 0:
            return
        while i < len(sizes) and (sizes[i] > left or not left_of[sizes[i]]):
            i += 1
        if left - below[i] > slack:
            continue
        if i == len(sizes):
            if left <= slack and undominated(left):
                yield chosen.copy()
            continue
        # Popped in this order: take the length, or go on without any more of it.
        stack.append((i + 1, left, -1))
        stack.append((i, left - sizes[i], sizes[i]))


def search(histogram: dict[int, int], capacity: int, aim: int, budget: int = SEARCH_BUDGET) -> list[tuple[list[int], int]] | None:
    """A solution of `aim` sequences by branch and bound; None if there is none, or the budget is used up."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in histogram.items():
        counts[s] = n
    nodes = [budget]

    def choices(slack: int):
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        found = fillings(capacity - top, counts.copy(), top, slack, nodes)
        counts[top] += 1
        for filling in found:
            filling = [top, *filling]
            waste = capacity - sum(filling)
            times = min(int(counts[s]) // filling.count(s) for s in set(filling))
            if waste:
                times = min(times, slack // waste)
            for k in dict.fromkeys((times, 1)):
                yield filling, k, waste * k

    def take(filling: list[int], k: int) -> None:
        for s in filling:
            counts[s] -= k

    path: list[tuple[list[int], int, int]] = []
    slack = aim * capacity - sum(s * n for s, n in histogram.items())
    levels = [choices(slack)]
    while levels and nodes[0] > 0:
        step = next(levels[-1], None)
        if step is None:
            levels.pop()
            if path:
                filling, k, waste = path.pop()
                take(filling, -k)
                slack += waste
            continue
        take(*step[:2])
        slack -= step[2]
        path.append(step)
        if not counts.any():
            return [(filling, k) for filling, k, _ in path]
        levels.append(choices(slack))
    return None


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """ceil(sum / capacity), or what the lengths over half the capacity leave no room for (Martello and Toth)."""
    n = np.zeros(capacity + 1, dtype=np.int64)
    for s, k in histogram.items():
        n[s] = k
    size = n * np.arange(capacity + 1)
    half = capacity // 2
    best = -(-int(size.sum()) // capacity)
    for least in range(half + 1):
        big = int(n[half + 1 :].sum())
        room = int((capacity * n - size)[half + 1 : capacity - least + 1].sum())
        best = max(best, big + max(0, -(-(int(size[least : half + 1].sum()) - room) // capacity)))
    return best


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one sequence, largest first) and how many sequences take each."""
    histogram = {s: n for s, n in histogram.items() if n}
    best = greedy(histogram, capacity)
    low, high = lower_bound(histogram, capacity), sum(k for _, k in best)
    aim, budget = low, SEARCH_BUDGET
    while low < high and budget:
        found, budget = search(histogram, capacity, aim, budget), budget // 2
        if found:
            best, high = found, sum(k for _, k in found)
        else:
            low = aim + 1
        aim = (low + high) // 2
    return best


def greedy(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """The incumbent: the best filling found around the largest length left, committed at once."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in histogram.items():
        counts[s] = n
    out: list[tuple[list[int], int]] = []
    top = capacity
    while True:
        while top and not counts[top]:
            top -= 1
        if not top:
            return out
        counts[top] -= 1
        filling = [top, *best_filling(capacity - top, counts, top)]
        counts[top] += 1
        need = {s: filling.count(s) for s in set(filling)}
        times = max(1, min(int(counts[s]) // k for s, k in need.items()))
        for s, k in need.items():
            counts[s] -= times * k
        out.append((filling, times))


def rank_table(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[list[int], list[tuple[int, int, int, tuple[int, ...]]]]]:
    """For each length: first ranks of its ranges, and (first rank, first sequence, items a sequence, offsets)."""
    table: dict[int, tuple[list[int], list]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for lengths, times in patterns:
        offsets: dict[int, list[int]] = {}
        at = 0
        for s in lengths:
            offsets.setdefault(s, []).append(at)
            at += s
        for s, places in offsets.items():
            firsts, ranges = table.setdefault(s, ([], []))
            rank = given.get(s, 0)
            firsts.append(rank)
            ranges.append((rank, sequence, len(places), tuple(places)))
            given[s] = rank + times * len(places)
        sequence += times
    return table


def pack(piece_rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` of 1 to `capacity`."""
    rows = cut(piece_rows.withColumn("part", F.spark_partition_id()))
    counts = rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut(counts.withColumn("first_rank", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = rank_table(solve(histogram, capacity))
    per_part = firsts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("length", "first_rank"))).alias("first_ranks"))
    schema = rows.drop("part").schema.add("sequence_id", "long").add("offset", "long")
    names = rows.drop("part").columns

    # The table of a partition's first ranks rides on its rows (capacity entries at most).
    joined = rows.groupBy("part").cogroup(per_part.groupBy("part"))

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            return pa.table({n: [] for n in schema.fieldNames()}, schema=pa_schema(left, names))
        ranks = dict(right.column("first_ranks")[0].as_py())
        sequences, offsets = [], []
        for length in left.column("length").to_pylist():
            rank = ranks[length]
            ranks[length] = rank + 1
            starts, ranges = table[length]
            first, sequence, each, places = ranges[bisect_right(starts, rank) - 1]
            q, k = divmod(rank - first, each)
            sequences.append(sequence + q)
            offsets.append(places[k])
        out = left.select(names)
        return out.append_column("sequence_id", pa.array(sequences, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return joined.applyInArrow(place, schema)


def pa_schema(table: pa.Table, names: list[str]) -> pa.Schema:
    return pa.schema([*(table.schema.field(n) for n in names), pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())])


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    packed = pack(pieces(docs, tokenizer_path, capacity), capacity)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), default_tokenizer())
