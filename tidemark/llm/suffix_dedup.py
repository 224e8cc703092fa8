"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

Every byte covered by a `window`-byte string that also starts anywhere else (same document or
another) goes. Only suffixes with `window` bytes left matter, and only through their first
`window` bytes, so they are ordered that far: most-significant-digit passes of eight bytes split
groups of equal prefixes, groups of one leave at once, and the groups left after the last pass are
exactly the repeated windows.

The passes need the suffixes of a group in one place. The corpus is dealt out by an anchor: of the
grams of GRAM bytes inside a window the one with the smallest hash. Equal windows have equal
anchors at equal places, and neighbouring windows mostly share theirs, so an anchor (one in about
70 bytes) stands for its whole run of windows:

1. A map finds the anchors of all texts and sends packed (anchor hash, hash of the run's bytes,
   place) entries. Equal texts are one entity (128-bit hash), however many rows hold it.
2. Anchors met once end here. Runs equal to another run (64 bits each of anchor and run, the
   latter over the run's bytes and bounds) are repeated whole. Where runs of one anchor differ, the bytes of one run of each kind are
   fetched, and step 3 finds which of its windows are repeated.
3. Radix passes over the windows of these runs, dealt by anchor.
4. An anchor with more than HOT_ENTRIES entries (a text that many documents hold, with different
   text around it) takes no part in steps 2 and 3: its windows are dealt by their hash (128 bits:
   window and anchor). What repeats inside one batch of entries is known there, and a batch sends
   a window once, so no group grows with an anchor or with the holders of a window.
5. The intervals found go back to their texts. A text that two or more rows hold is repeated whole
   if it is as long as a window.

Null text: empty. Texts shorter than the window: nothing goes. Repeated rows are two documents.
Empty table: no rows. Extra columns are ignored. Spans are judged on the input.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop, store
from .textkit import _INVERSE, bounded_batches, buffers, chunks, documents, mix, narrow, powers, prefix_hash, span_hash

WINDOW = 200
GRAM = 64
BUCKET_ENTRIES = 400_000
BUCKET_RUNS = 8_000
FLUSH_ENTRIES = 600_000
HOT_ENTRIES = 20_000
FLUSH_WINDOWS = 400_000


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchor_runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Document, anchor hash, run hash, anchor place, and distance back from it to the first and last window of its run."""
    n = len(data)
    if n < window:
        return None
    lengths = np.diff(offsets)
    long_enough = np.flatnonzero(lengths >= window)
    if not len(long_enough):
        return None
    running = prefix_hash(data)
    grams = (running[gram:] - running[:-gram]) * powers(_INVERSE, n + 1)[: n - gram + 1]
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    bits = max(24, n.bit_length())
    low = np.uint64((1 << bits) - 1)
    lowest = sliding_minimum((grams & ~low) | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
    begins, counts = offsets[:-1][long_enough], lengths[long_enough] - window + 1
    starts = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    place = (lowest[starts] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], len(place)) - 1
    at, s0, s1 = place[first], starts[first], starts[last]
    run = span_hash(running, s0, s1 + window) + mix(((at - s0) * 4096 + (at - s1)).astype(np.uint64))
    doc = np.searchsorted(offsets, at, side="right") - 1
    return doc, mix(grams[at]), run, at - offsets[doc], at - s0, at - s1


def repeated_windows(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, window: int) -> np.ndarray:
    """Which windows have an equal one in their group: MSD radix passes of eight bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at_byte = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
    index = np.arange(len(starts))
    _, group = np.unique(groups, return_inverse=True)
    order = np.argsort(group, kind="stable")
    index, group = index[order], group[order]
    for depth in (-1, *range(0, window, 8)):
        if depth < 0:
            digit = np.zeros(len(index), dtype=np.uint64)
        else:
            digit = at_byte[starts[index] + depth]
            if depth + 8 > window:
                digit = digit & np.uint64((1 << (8 * (window - depth))) - 1)
            order = np.lexsort((digit, group))
            index, group, digit = index[order], group[order], digit[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])]) if len(index) else np.zeros(0, bool)
        single = new & np.append(new[1:], True) if len(index) else new
        group = np.cumsum(new)
        index, group = index[~single], group[~single]
        if not len(index):
            break
    out = np.zeros(len(starts), dtype=bool)
    out[index] = True
    return out


ENTRY = np.dtype([("anchor", "<u8"), ("run", "<u8"), ("place", "<u4"), ("back0", "u1"), ("back1", "u1")])
REQUEST = np.dtype([("anchor", "<u8"), ("place", "<i8"), ("back0", "<i4"), ("back1", "<i4"), ("whole", "<i4")])


def packed_by_bucket(bucket: np.ndarray, owner: np.ndarray, keys: list[np.ndarray], records: np.ndarray) -> pa.RecordBatch:
    """Rows of one bucket each: keys of the owners, records held by each, and the records."""
    order = np.lexsort((owner, bucket))
    bucket, owner, records = bucket[order], owner[order], records[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        new = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
        who = owner[a:b][new]
        rows.append((int(bucket[a]), *(k[who].tobytes() for k in keys), np.diff(new, append=b - a).astype(np.int32).tobytes(), records[a:b].tobytes()))
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), *[pa.binary()] * 4))], names=["bucket", "h1", "h2", "held", "records"])


PACKED = "bucket int, h1 binary, h2 binary, held binary, records binary"


def unpacked(table: pa.Table, kind: np.dtype):
    def joined(name, k):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=k)

    held = joined("held", np.int32)
    return np.repeat(joined("h1", np.int64), held), np.repeat(joined("h2", np.int64), held), joined("records", kind)


def by_entity(h1: np.ndarray, h2: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    order = np.lexsort((h2, h1))
    h1, h2, records = h1[order], h2[order], records[order]
    new = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])) if len(h1) else np.zeros(0, np.int64)
    ends = np.append(new[1:], len(h1))
    return h1[new], h2[new], [records[a:b].tobytes() for a, b in zip(new, ends)]


FOUND = "kind int, h1 long, h2 long, records binary"


def found_table(parts) -> pa.Table:
    kinds = np.concatenate([np.full(len(h1), kind, np.int32) for kind, (h1, _, _) in parts])
    return pa.table(
        [pa.array(kinds), pa.array(np.concatenate([p[0] for _, p in parts]).astype(np.int64)), pa.array(np.concatenate([p[1] for _, p in parts]).astype(np.int64)), pa.array([r for _, p in parts for r in p[2]], pa.binary())],
        names=["kind", "h1", "h2", "records"],
    )


def hot_anchors(texts: DataFrame, window: int, gram: int) -> list[int]:
    """Anchors with more than HOT_ENTRIES entries; one that FLUSH_ENTRIES entries of a task hold once doesn't count there."""

    def run(batches):
        held, size = [], 0

        def flush():
            anchor, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(anchor[count > 1].view(np.int64)), pa.array(count[count > 1])], names=["anchor", "n"])

        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for _, _, part, at in chunks(data, offsets):
                found = anchor_runs(part, at, window, gram)
                if found is not None:
                    held.append(found[1])
                    size += len(found[1])
                if size >= FLUSH_ENTRIES:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    counts = texts.select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return sorted(r[0] for r in counts.where(F.col("n") > HOT_ENTRIES).select("anchor").collect())


WINDOWS = np.dtype([("key", "<u8"), ("anchor", "<u8"), ("begin", "<u4"), ("end", "<u4"), ("known", "u1")])


def joined_places(owner: np.ndarray, begin: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners, begins and ends of the intervals that windows at consecutive places make up."""
    if not len(owner):
        return owner, begin, begin
    order = np.lexsort((begin, owner))
    owner, begin = owner[order], begin[order]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (begin[1:] > begin[:-1] + 1)]))
    last = np.append(new[1:], len(owner)) - 1
    return owner[new], begin[new], begin[last] + window


def hot_entries(texts: DataFrame, buckets: int, window: int, gram: int, hot: list[int]) -> DataFrame:
    """Windows of hot anchors: known 0 stands alone in its batch, 1 is a found interval, 2 a window found already."""
    anchors = texts.sparkSession.sparkContext.broadcast(np.asarray(hot, dtype=np.int64).view(np.uint64))

    def run(batches):
        parts, h1s, h2s, size, seen = [], [], [], 0, set()

        def flush():
            key, anchor, owner, begin = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((anchor, key))
            key, anchor, owner, begin = key[order], anchor[order], owner[order], begin[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (anchor[1:] != anchor[:-1])])
            twice = ~(new & np.append(new[1:], True))
            who, first, end = joined_places(owner[twice], begin[twice], window)
            sent = np.zeros(int(new.sum()), dtype=WINDOWS)
            for name, values in zip(WINDOWS.names, (key[new], anchor[new], begin[new], begin[new] + window, 2 * twice[new])):
                sent[name] = values
            known = np.zeros(len(who), dtype=WINDOWS)
            known["begin"], known["end"], known["known"] = first, end, 1
            bucket = np.concatenate([sent["key"] >> np.uint64(17), mix(who.astype(np.uint64))]) % np.uint64(buckets)
            return packed_by_bucket(bucket.astype(np.int32), np.concatenate([owner[new], who]), [np.asarray(h1s, dtype=np.int64), np.asarray(h2s, dtype=np.int64)], np.concatenate([sent, known]))

        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
            for first, end, part, at in chunks(data, offsets):
                found = anchor_runs(part, at, window, gram)
                if found is None:
                    continue
                doc, anchor, _, place, back0, back1 = found
                mine = np.isin(anchor, anchors.value)
                number = np.full(end - first, -1, dtype=np.int64)
                for d in np.unique(doc[mine]).tolist():
                    key = (h1[first + d], h2[first + d])
                    if key not in seen:
                        seen.add(key)
                        number[d] = len(h1s)
                        h1s.append(key[0])
                        h2s.append(key[1])
                mine &= number[doc] >= 0
                doc, anchor, count = doc[mine], anchor[mine], (back0 - back1 + 1)[mine]
                start = np.repeat(place[mine] - back0[mine], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                running = prefix_hash(part)
                for some in range(0, len(start), FLUSH_WINDOWS):
                    pick = slice(some, some + FLUSH_WINDOWS)
                    who = np.repeat(doc, count)[pick]
                    begin = start[pick] + at[who]
                    parts.append((span_hash(running, begin, begin + window), np.repeat(anchor, count)[pick], number[who], start[pick]))
                    size += len(begin)
                    if size >= FLUSH_WINDOWS:
                        yield flush()
                        parts, size = [], 0
                if not parts:
                    h1s, h2s, seen = [], [], set()
        if size:
            yield flush()

    return texts.select("text", "h1", "h2").mapInArrow(run, PACKED)


def resolve_windows(window: int):
    """Function of one bucket of windows of hot anchors: the repeated intervals."""

    def run(table: pa.Table) -> pa.Table:
        h1, h2, e = unpacked(table, WINDOWS)
        given = e["known"] == 1
        parts = [(h1[given], h2[given], e["begin"][given], e["end"][given])]
        h1, h2, e = h1[~given], h2[~given], e[~given]
        if len(e):
            order = np.lexsort((e["begin"], h2, h1, e["anchor"], e["key"]))
            h1, h2, e = h1[order], h2[order], e[order]
            same = (e["key"][1:] == e["key"][:-1]) & (e["anchor"][1:] == e["anchor"][:-1])
            other = same & ((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (e["begin"][1:] != e["begin"][:-1]))
            group = np.cumsum(np.concatenate([[True], ~same])) - 1
            again = np.bincount(group, weights=np.concatenate([[False], other]) + (e["known"] == 2)) > 0
            pick = again[group]
            parts.append((h1[pick], h2[pick], e["begin"][pick], e["end"][pick]))
        h1, h2, begin, end = (np.concatenate(x) for x in zip(*parts))
        return found_table([(0, by_entity(h1, h2, np.stack([begin, end], axis=1).astype(np.int64)))])

    return run


def anchor_entries(texts: DataFrame, buckets: int, window: int, gram: int, hot: list[int]) -> DataFrame:
    anchors = texts.sparkSession.sparkContext.broadcast(np.asarray(hot, dtype=np.int64).view(np.uint64))

    def run(batches):
        parts, h1s, h2s, size, seen = [], [], [], 0, set()

        def flush():
            records = np.concatenate([r for _, r in parts])
            bucket = ((records["anchor"] >> np.uint64(17)) % np.uint64(buckets)).astype(np.int32)
            return packed_by_bucket(bucket, np.concatenate([o for o, _ in parts]), [np.asarray(h1s, dtype=np.int64), np.asarray(h2s, dtype=np.int64)], records)

        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
            for first, end, part, at in chunks(data, offsets):
                found = anchor_runs(part, at, window, gram)
                if found is None:
                    continue
                number = np.full(end - first, -1, dtype=np.int64)
                for d in np.flatnonzero(np.diff(at) >= window).tolist():
                    key = (h1[first + d], h2[first + d])
                    if key not in seen:
                        seen.add(key)
                        number[d] = len(h1s)
                        h1s.append(key[0])
                        h2s.append(key[1])
                doc, anchor, run_hash, place, back0, back1 = found
                mine = (number[doc] >= 0) & ~np.isin(anchor, anchors.value)
                records = np.empty(int(mine.sum()), dtype=ENTRY)
                for name, values in zip(ENTRY.names, (anchor, run_hash, place, back0, back1)):
                    records[name] = values[mine]
                parts.append((number[doc][mine], records))
                size += len(records)
                if size >= FLUSH_ENTRIES:
                    yield flush()
                    parts, h1s, h2s, size, seen = [], [], [], 0, set()
        if size:
            yield flush()

    return texts.select("text", "h1", "h2").mapInArrow(run, PACKED)


def resolve_entries(window: int):
    """Function of one bucket of entries: repeated intervals (kind 0) and runs to compare (kind 1)."""

    def run(table: pa.Table) -> pa.Table:
        h1, h2, e = unpacked(table, ENTRY)
        order = np.argsort(e["anchor"], kind="stable")
        a = e["anchor"][order]
        twice = np.zeros(len(a), dtype=bool)
        twice[1:] |= a[1:] == a[:-1]
        twice[:-1] |= a[1:] == a[:-1]
        order = order[twice]
        h1, h2, e = h1[order], h2[order], e[order]
        order = np.lexsort((e["place"], h2, h1, e["run"], e["anchor"]))
        h1, h2, e = h1[order], h2[order], e[order]
        anchor, kind = e["anchor"], e["run"]
        if len(e):
            keep = np.ones(len(e), dtype=bool)
            keep[1:] = (anchor[1:] != anchor[:-1]) | (kind[1:] != kind[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (e["place"][1:] != e["place"][:-1])
            h1, h2, e = h1[keep], h2[keep], e[keep]
            anchor, kind = e["anchor"], e["run"]
            new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            new_run = new_anchor | np.concatenate([[True], kind[1:] != kind[:-1]])
            run_id = np.cumsum(new_run) - 1
            whole = np.bincount(run_id)[run_id] > 1
            kinds = np.add.reduceat(new_run.astype(np.int64), np.flatnonzero(new_anchor))
            compared = new_run & (kinds[np.cumsum(new_anchor) - 1] > 1)
        else:
            whole = compared = np.zeros(0, dtype=bool)
        place = e["place"].astype(np.int64)
        spans = np.stack([place - e["back0"], place - e["back1"] + window], axis=1)[whole]
        requests = np.empty(int(compared.sum()), dtype=REQUEST)
        for name, values in zip(REQUEST.names, (anchor, place, e["back0"], e["back1"], whole)):
            requests[name] = values[compared]
        return found_table([(0, by_entity(h1[whole], h2[whole], spans)), (1, by_entity(h1[compared], h2[compared], requests))])

    return run


def run_bytes(joined: DataFrame, buckets: int, window: int) -> DataFrame:
    """Sends each requested run's bytes to the bucket of its anchor."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows, owner, texts = [], [], part.column("text").to_pylist()
                h1, h2 = (np.asarray(part.column(c).to_pylist(), dtype=np.int64) for c in ("h1", "h2"))
                for k, (text, lists) in enumerate(zip(texts, part.column("requests").to_pylist())):
                    raw = text.encode()
                    requests = np.frombuffer(b"".join(lists), dtype=REQUEST)
                    for r in requests.tolist():
                        begin, end = r[1] - r[2], r[1] - r[3] + window
                        rows.append((r[0] >> 11, h1[k], h2[k], r[0], begin, r[2], r[4], raw[begin:end]))
                if rows:
                    columns = list(zip(*rows))
                    bucket = [b % buckets for b in columns[0]]
                    order = np.argsort(bucket, kind="stable")
                    cuts = np.flatnonzero(np.diff(np.asarray(bucket)[order], prepend=-1, append=-1))
                    out = []
                    for a, b in zip(cuts[:-1], cuts[1:]):
                        pick = order[a:b].tolist()
                        heads = np.asarray([[np.uint64(columns[3][i]).view(np.int64), columns[1][i], columns[2][i], columns[4][i], columns[5][i], columns[6][i], len(columns[7][i])] for i in pick], dtype=np.int64)
                        out.append((bucket[pick[0]], heads.tobytes(), b"".join(columns[7][i] for i in pick)))
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "heads", "bytes"])

    return joined.mapInArrow(run, "bucket int, heads binary, bytes binary")


def compare_runs(window: int):
    """Function of one bucket of runs: the repeated interval of each run that isn't repeated whole."""

    def run(table: pa.Table) -> pa.Table:
        heads = np.frombuffer(b"".join(table.column("heads").to_pylist()), dtype=np.int64).reshape(-1, 7)
        data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), dtype=np.uint8)
        length = heads[:, 6]
        base = np.cumsum(length) - length
        _, first = np.unique(heads[:, [0, 1, 2, 3]], axis=0, return_index=True)  # rows of one id and text ask once
        heads, base, length = heads[first], base[first], length[first]
        count = length - window + 1
        owner = np.repeat(np.arange(len(heads)), count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        group = mix(heads[owner, 0].view(np.uint64)) + (heads[owner, 4] - step).astype(np.uint64)
        again = repeated_windows(data, base[owner] + step, group, window)
        again &= heads[owner, 5] == 0
        owner, step = owner[again], step[again]
        new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
        last = np.append(new[1:], len(owner)) - 1
        who = owner[new]
        spans = np.stack([heads[who, 3] + step[new], heads[who, 3] + step[last] + window], axis=1) if len(who) else np.zeros((0, 2), np.int64)
        return found_table([(0, by_entity(heads[who, 1], heads[who, 2], spans))])

    return run


def kept_runs(n: int, spans: np.ndarray) -> list[tuple[int, int]]:
    """What is left of n bytes without the spans."""
    out, at = [], 0
    for begin, end in sorted(spans.tolist()):
        if begin > at:
            out.append((at, begin))
        at = max(at, end)
    if at < n:
        out.append((at, n))
    return out


def removal_table(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` (as c0..) with `spans`: int64 pairs (begin, end) of repeated bytes, overlapping in any order, or null."""
    if not gram <= window <= gram + 255:
        raise ValueError("a window is at most 255 bytes longer than a gram")  # distances to an anchor are kept in a byte
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    h1, h2 = F.xxhash64(text), F.xxhash64(F.lit(17), text)
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    texts = docs.select(key.alias("key"), text.alias("text"), h1.alias("h1"), h2.alias("h2"))
    measured = texts.select("key", "h1", "h2", F.octet_length("text").alias("bytes"))
    total = measured.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(8, math.ceil(total / ((window - gram + 2) / 2) / BUCKET_ENTRIES))
    hot = hot_anchors(texts, window, gram)
    found = anchor_entries(texts, buckets, window, gram, hot).groupBy("bucket").applyInArrow(resolve_entries(window), FOUND)
    if hot:
        found = found.union(hot_entries(texts, 8 * buckets, window, gram, hot).groupBy("bucket").applyInArrow(resolve_windows(window), FOUND))
    found, found_path = store(found)

    asked = found.where("kind = 1")
    runs = asked.agg(F.sum(F.octet_length("records"))).first()[0] or 0
    run_buckets = max(8, math.ceil(runs / REQUEST.itemsize / BUCKET_RUNS))
    entities = measured.groupBy("h1", "h2").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.max("bytes").alias("bytes"))
    requests = asked.groupBy("h1", "h2").agg(F.collect_list("records").alias("requests")).join(entities.select("h1", "h2", "key"), ["h1", "h2"])
    compared = run_bytes(texts.join(requests, ["h1", "h2", "key"]).select("text", "h1", "h2", "requests"), run_buckets, window)
    compared, compared_path = store(compared.groupBy("bucket").applyInArrow(compare_runs(window), FOUND))

    copies = entities.where((F.col("copies") > 1) & (F.col("bytes") >= window)).select("h1", "h2", F.col("bytes").cast("long").alias("whole"))
    spans = found.where("kind = 0").select("h1", "h2", "records").union(compared.select("h1", "h2", "records"))
    spans = spans.groupBy("h1", "h2").agg(F.collect_list("records").alias("spans"))
    removals, removals_path = store(spans.join(copies, ["h1", "h2"], "full"))
    drop(spark, found_path)
    drop(spark, compared_path)
    names = docs.columns
    tagged = docs.select(*(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)), h1.alias("h1"), h2.alias("h2"))
    return tagged.join(removals, ["h1", "h2"], "left").select(*(f"c{i}" for i in range(len(names))), "spans", "whole")


def spans_of(whole, lists) -> np.ndarray:
    if whole is not None:
        return np.asarray([[0, whole]], dtype=np.int64)
    return np.frombuffer(b"".join(lists or []), dtype=np.int64).reshape(-1, 2)


def removal_digests(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = narrow(docs, "doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = [], [], [], []
                for text, lists, whole in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist()):
                    raw = (text or "").encode()
                    kept = kept_runs(len(raw), spans_of(whole, lists))
                    left = b"".join(raw[a:b] for a, b in kept)
                    gaps = [0, *(x for run_ in kept for x in run_), len(raw)]
                    spans = sum(b > a for a, b in zip(gaps[::2], gaps[1::2]))
                    for column, value in zip(out, (len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest())):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return removal_table(rows, window, gram).mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """`docs` with the repeated windows cut out of `text` (a character cut in two goes whole) and `n_chars` renewed."""
    names = docs.columns
    schema = docs.toDF(*(f"c{i}" for i in range(len(names)))).schema

    def run(batches):
        where = names.index("text")
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = []
                for text, lists, whole in zip(*(part.column(c).to_pylist() for c in (where, len(names), len(names) + 1))):
                    spans = spans_of(whole, lists)
                    if text and len(spans):
                        raw = text.encode()
                        text = "".join(raw[a:b].decode(errors="ignore") for a, b in kept_runs(len(raw), spans))
                    texts.append(text)
                columns = [part.column(i) for i in range(len(names))]
                columns[where] = pa.array(texts, columns[where].type)
                if "n_chars" in names:
                    at_chars = names.index("n_chars")
                    columns[at_chars] = pa.array([None if t is None else len(t) for t in texts], columns[at_chars].type)
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return removal_table(docs, window, gram).mapInArrow(run, schema).toDF(*names)


def op7_suffix_dedup(spark, sf_dir):
    return removal_digests(documents(spark, sf_dir))
