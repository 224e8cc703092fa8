import collections
import random
import zlib

import pytest
import xxhash

from tidemark.llm import sharding as S


def brute(rows, shards):
    """Rows in order of a signed 64-bit hash of the text, then id (none first), placed by their middle byte."""
    def order(row):
        d, text = row
        h = xxhash.xxh64((text or "").encode(), seed=42).intdigest()
        return (h - (1 << 64) if h >> 63 else h, d is not None, d or 0)

    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    before, out, slots = 0, [], collections.Counter()
    for d, text in sorted(rows, key=order):
        raw = (text or "").encode()
        size = len(raw) + 1
        shard = min((2 * before + size) * shards // (2 * total), shards - 1)
        out.append((d, size, zlib.crc32(raw), shard, slots[shard]))
        slots[shard] += 1
        before += size
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.randint(0, 400) + rng.choice(["é", "", "漢"])) for i in range(900)]
    rows += [(1000 + i, "same text " * 9) for i in range(400)] + [(2000, None), (2001, ""), (3, "again"), (3, "again"), (None, "no id"), (2002, "long " * 60_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_match_brute_force(spark, shards):
    rows = corpus(1)
    df = spark.createDataFrame([(*r, 7, 8, 9, 10) for r in rows], "doc_id long, text string, size int, part int, before int, shard int").repartition(5)
    got = S.shard_table(df, shards)
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, shards)


def test_shards_are_balanced_contiguous_and_gapless(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 400) + "é", 1) for i in range(900)] + [(1000 + i, "same text " * 9, 1) for i in range(400)] + [(2000, None, 1), (2001, "", 1), (3, "again", 1), (3, "again", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size int")
    out = S.shard_table(df, 8).collect()
    assert len(out) == len(rows)
    size = collections.Counter()
    slots = collections.defaultdict(list)
    for r in out:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(size) == set(range(8)) and max(size.values()) - min(size.values()) < 2 * 402
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert want == collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out)


def test_empty_and_tiny_tables(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert S.shard_table(df.limit(0)).count() == 0
    assert S.shard_table(df).count() == 1
