import itertools
import random
import re

import pytest

from tidemark.llm import jaccard_join as J


def brute(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[root(i)] = min(best.get(root(i), d), d)
    return sorted((d, len(sets[i]), best[root(i)]) for i, (d, _) in enumerate(rows))


def near_rows(seed, families, copies):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    shared = [rng.choice(vocabulary) for _ in range(40)]
    rows, i = [], 0
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))] + (shared if f % 2 else [])
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                at = rng.randrange(len(text))
                text[at : at + 1] = [rng.choice(vocabulary)] * rng.choice([0, 1, 2])
                text = text or ["x"]
            rows.append((i, (" " if rng.random() < 0.5 else "\n").join(text)))
            i += 1
    rng.shuffle(rows)
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in J.similar_groups(df, **kw).select("doc_id", "n_shingles", "component_id").collect())


EDGES = [(900, None), (901, ""), (902, " \n\t"), (903, "a b"), (904, "A  B"), (905, "a b c"), (906, "a b c d e"), (907, "a b c d e a b c d e"), (908, "é É ü x y z"), (909, "é É ü x y Z")]


def test_matches_brute_force(spark):
    rows = near_rows(1, 60, 6) + EDGES
    assert run(spark, rows) == brute(rows)


def test_long_lists_and_hot_tiles_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(J, "LOCAL_REPEATS", 2)
    rows = near_rows(2, 12, 40)
    assert run(spark, rows, hot=7, small=3) == brute(rows)
    assert run(spark, rows, hot=7, small=3, group_grams=300) == brute(rows)


def test_repeated_rows_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 5, "x"), (1, "a b c d e f", 5, "x"), (None, "a b c d e f", 1, "z")], "doc_id long, text string, s long, n string")
    out = sorted((tuple(r) for r in J.similar_groups(df).select("doc_id", "component_id").collect()), key=str)
    assert out == [(1, 1), (1, 1), (None, 1)]
    assert J.similar_groups(df.limit(0)).count() == 0


def test_one_id_on_two_texts_keeps_both_texts_links(spark):
    rng = random.Random(4)
    a, b = ([f"{k}{rng.randrange(10_000)}" for _ in range(40)] for k in "ab")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, " ".join(a[:-1])), (9, " ".join(b[:-1])), (11, " ".join(a[:-1])), (20, "x y z")]
    want = brute(rows)
    assert run(spark, rows) == want == [(5, 36, 5), (5, 36, 5), (7, 35, 5), (9, 35, 5), (11, 35, 5), (20, 1, 20)]
    assert run(spark, rows, group_grams=1) == want
    assert run(spark, rows, small=1) == want
    df = spark.createDataFrame([(*r, 1, "k") for r in [*rows, rows[0], (None, rows[0][1]), (None, None), (30, None), (30, None), (31, "")]], "doc_id long, text string, `a.b` int, component long".replace("component long", "component string"))
    kept = J.one_of_each_group(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(5, rows[0][1]), (5, rows[1][1]), (20, "x y z"), (None, rows[0][1]), (None, None), (30, None), (30, None), (31, "")], key=str)
    assert J.one_of_each_group(df.limit(0)).count() == 0


def test_random_ids_on_several_texts_match_brute_force(spark):
    rows = [(i % 40, t) for i, t in near_rows(5, 25, 5)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, group_grams=200) == brute(rows)


def test_a_very_long_text_and_its_near_copy(spark):
    words = [f"w{i % 9973}x{i % 7}" for i in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-3000])), (3, " ".join(words[:30_000])), (4, "a b c d e f")]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 100, 501])
def test_prefix_keeps_every_link(n):
    need = -(-75 * n // 100)
    assert J.prefix_length(n) + need == n + 1
