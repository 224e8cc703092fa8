import collections
import math
import random
import re

import numpy as np

from tidemark.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def rows(seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(150):
        junk = i % 5 == 4
        words = [(rng.choice(["x#", "y$$", "|", "z&"]) if junk else f"good{rng.randrange(40)}é") for _ in range(rng.randint(1, 90))]
        if rng.random() < 0.3:
            words += words[:30]
        out.append((i, "".join(w + rng.choice([" ", " ", "\n", "\t", " \n"]) for w in words)))
    return out + [(900, None), (901, ""), (902, " \n\n "), (903, "a\na\n a\na\n" * 6), (904, "w " * 30_000), (3, out[3][1])]


def test_page_rules_match_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1, "k") for r in data], "doc_id long, text string, c0 long, kept string")
    labels = spark.createDataFrame([(i, int(i % 5 != 4), 0) for i in range(0, 100)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    out = Q.judge(df, labels).collect()
    got = sorted((r["c0"] or 0, *(r[f"f_{n}"] for n in Q.FACTS), r["f_base_failed"]) for r in out)
    assert got == sorted((d, *brute(t)) for d, t in data)
    assert all(not r["f_kept"] for r in out if r["f_base_failed"])
    clean = [r for r in out if not r["f_base_failed"] and r["c0"] < 150]
    wrong = [r for r in clean if r["f_kept"] != (r["c0"] % 5 != 4)]
    assert not wrong
    assert Q.keep_good(df, labels).columns == df.columns
    assert Q.judge(df.limit(0), labels).count() == 0
    assert all(r["f_ratio"] == 0 for r in Q.judge(df, labels.limit(0)).collect())


def test_ratio_is_the_mean_weight(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "c")], "doc_id long, text string")
    weights = Q.ratio_weights(df, [1], 64)
    assert weights.max() > 0 > weights.min()
    r = {x["c0"]: x["f_ratio"] for x in Q.judged(df, weights).collect()}
    assert np.sign(r[1]) == 1 and np.sign(r[2]) == -1


def test_counts_are_exact_sums_over_all_partitions(spark):
    data = rows(2)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    buckets, trusted = 1 << 15, [i for i in range(0, 100) if i % 5 != 4]
    want = np.zeros((2, buckets), dtype=np.int64)
    for i, text in data:
        data_, offsets = np.frombuffer((text or "").encode(), np.uint8), np.asarray([0, len((text or "").encode())])
        starts, ends, first = Q.find_words(data_, offsets)
        bucket, _ = Q.gram_buckets(Q.span_hash(Q.prefix_hash(data_), starts, ends), first, buckets)
        want[0] += np.bincount(bucket, minlength=buckets)
        want[1] += np.bincount(bucket, minlength=buckets) * (i in trusted)
    got = np.zeros((2, buckets), dtype=np.int64)
    for r in Q.gram_counts(df, trusted, buckets).collect():
        width = len(r["raw"]) // 8
        got[0, r["slice"] * width :][:width], got[1, r["slice"] * width :][:width] = np.frombuffer(r["raw"], np.int64), np.frombuffer(r["good"], np.int64)
    assert (got == want).all()
    share = want[1].sum() / want[0].sum()
    assert np.allclose(Q.ratio_weights(df, trusted, buckets), np.log((want[1] + Q.PRIOR) / (want[0] * share + Q.PRIOR)), atol=1e-6)


def test_ratios_match_a_plain_count(spark):
    data = rows(3)
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 != 4), 0) for i in range(0, 100)], "doc_id long, quality int, toxic int")

    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        return [*words, *zip(words, words[1:])]

    raw = collections.Counter(g for _, t in data for g in grams(t))
    good = collections.Counter(g for i, t in data if i < 100 and i % 5 != 4 for g in grams(t))
    share = sum(good.values()) / sum(raw.values())
    weight = {g: math.log((good[g] + Q.PRIOR) / (raw[g] * share + Q.PRIOR)) for g in raw}
    want = {t or "": sum(weight[g] for g in grams(t)) / max(1, len(grams(t))) for _, t in data}
    got = Q.judge(df, labels).collect()
    assert len(got) == len(data)
    for r in got:
        assert math.isclose(r["f_ratio"], want[r["c1"] or ""], abs_tol=5e-3)  # a few of the n-grams share a counter
        assert r["f_kept"] == (not r["f_base_failed"] and want[r["c1"] or ""] >= Q.THRESHOLD)


def test_weights_depend_on_shares_not_on_the_size_of_the_corpus(spark):
    rng = random.Random(9)
    text = lambda i: " ".join(f"j{rng.randrange(40)}" if i % 5 == 0 else f"w{rng.randrange(40)}" for _ in range(200))
    once = [(i, text(i)) for i in range(100)]
    scores = []
    for copies in (1, 8):
        df = spark.createDataFrame([(i + 1000 * k, t) for k in range(copies) for i, t in once], "doc_id long, text string")
        trusted = [i + 1000 * k for k in range(copies) for i, _ in once if i % 5]
        at_least = Q.PRIOR_SHARE
        Q.PRIOR_SHARE = 1e-3  # as if the table were small, so that the prior is its share in both
        try:
            weights = Q.ratio_weights(df, trusted, 1 << 16)
        finally:
            Q.PRIOR_SHARE = at_least
        scores.append({r["c0"]: r["f_ratio"] for r in Q.judged(df, weights).where("c0 < 1000").collect()})
    assert all(math.isclose(scores[0][i], scores[1][i], abs_tol=1e-6) for i in scores[0])


def test_junk_that_shares_no_counter_is_rejected_in_a_large_vocabulary(spark):
    rng = random.Random(7)
    word = lambda kind: f"{kind}{rng.randrange(200_000)}"
    junk = [f"j{i}" for i in range(6000)]
    data = [(i, " ".join(rng.choice(junk) if i % 20 == 0 else word("w") for _ in range(400))) for i in range(1200)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1200) if i % 20], "doc_id long, quality int, toxic int")
    out = Q.judge(df, labels).where("NOT f_base_failed").collect()
    assert all(r["f_kept"] == (r["c0"] % 20 != 0) for r in out) and len(out) == len(data)
