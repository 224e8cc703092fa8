import collections
import hashlib
import random

import numpy as np

from tidemark.llm import suffix_dedup as S


def brute(rows, window):
    count = collections.Counter()
    raws = [(d, (t or "").encode()) for d, t in rows]
    for _, raw in raws:
        for i in range(len(raw) - window + 1):
            count[raw[i : i + window]] += 1
    out = []
    for d, raw in raws:
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - window + 1):
            if count[raw[i : i + window]] > 1:
                gone[i : i + window] = True
        gone[-1] = False
        spans = int((gone[:-1] & ~gone[1:]).sum()) if len(raw) else 0
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß ") for _ in range(rng.randint(1, 9)))
    passages = ["".join(word() for _ in range(rng.randint(5, 60))) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [rng.choice(passages) if rng.random() < 0.4 else "".join(word() for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 6))]
        text = "".join(parts)
        if rng.random() < 0.3 and text:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at + 1 :]
        rows.append((i, text))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, "x" * 900), (205, "ab" * 300), (206, "x" * 230), (3, rows[3][1]), (None, rows[5][1])]
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in S.removal_digests(df, **kw).collect()), key=str)


def test_matches_brute_force(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows, 200)


def test_small_windows_match_brute_force(spark):
    rows = corpus(2)
    assert run(spark, rows, window=41, gram=9) == brute(rows, 41)


def test_text_column_is_cut_and_empty_table(spark):
    rows = [(1, "a" * 10 + "0123456789" * 40, "k", 9), (2, "0123456789" * 40 + "é", "k", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h1 string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["h1"], r["n_chars"]) for r in S.without_repeats(df).collect()}
    assert got == {1: ("a" * 10, "k", 10), 2: ("é", "k", 1)}
    assert S.removal_digests(df.limit(0)).count() == 0


def test_radix_passes_find_equal_windows():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 2, 4000, dtype=np.uint8)
    starts = np.arange(len(data) - 12)
    seen = collections.Counter(bytes(data[i : i + 13]) for i in starts)
    starts = np.arange(len(data) - 12)
    got = S.repeated_windows(data, starts, np.zeros(len(starts), np.int64), 13)
    assert got.tolist() == [seen[bytes(data[i : i + 13])] > 1 for i in starts]


def test_no_task_compares_all_runs_of_a_hot_anchor(spark, monkeypatch):
    rng = random.Random(4)
    other = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    head = other(150)
    rows = [(i, other(rng.randint(0, 90)) + head + other(rng.randint(0, 90))) for i in range(120)]
    rows += [(1000 + i, rows[i][1][:200] + "#" + other(40)) for i in range(0, 60, 3)] + [(2000, rows[7][1]), (2001, head + head + head)]
    rows += [(3000 + i, other(30) + head + "0123456789" * 6) for i in range(40)]
    kept = S.compare_runs

    def compare_runs(window):
        compare = kept(window)

        def run(table):
            anchors = np.frombuffer(b"".join(table.column("heads").to_pylist()), dtype=np.int64).reshape(-1, 7)[:, 0]
            assert np.unique(anchors, return_counts=True)[1].max() <= 60, "one anchor's runs in one task"
            return compare(table)

        return run

    monkeypatch.setattr(S, "compare_runs", compare_runs)
    monkeypatch.setattr(S, "HOT_ENTRIES", 40)
    assert run(spark, rows) == brute(rows, 200)
    assert len(S.hot_anchors(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 200, 64)) > 0
    monkeypatch.setattr(S, "HOT_ENTRIES", 1)
    monkeypatch.setattr(S, "FLUSH_WINDOWS", 500)
    assert run(spark, corpus(1)) == brute(corpus(1), 200)
