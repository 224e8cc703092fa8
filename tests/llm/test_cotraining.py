import random

from tidemark.llm import cotraining as C


def rows(n=700, seed=3):
    rng = random.Random(seed)
    out, labels = [], []
    for i in range(n):
        junk, toxic = rng.random() < 0.25, rng.random() < 0.2
        words = [f"w{min(int(rng.expovariate(0.02)), 900)}" + ("##" if junk and rng.random() < 0.5 else "") for _ in range(rng.randint(20, 150))]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["nastyone", "nastytwo"])
        text = " ".join(words)
        out.append((i, text, "en", f"src{i % 7}", len(text), "extra"))
        labels.append((i, int(not junk), int(toxic)))
    return out, labels


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def test_held_out_accuracy_and_edges(spark):
    data, labels = rows()
    odd = [(None, "w1 w2", None, None, None, None), (9000, None, "en", "src1", 0, None), (9001, "", None, "src1", 0, None), (9002, "w3 " * 40_000, "en", "src1", 120_000, None), (9003, data[5][1], *data[5][2:]), (9003, data[5][1], *data[5][2:])]
    df = spark.createDataFrame(data + odd, SCHEMA)
    known = spark.createDataFrame([x for x in labels if x[0] < 400], "doc_id long, quality int, toxic int")
    out = {r["c0"]: r for r in C.classified(df, known).collect()}
    assert len(out) == len(data) + 5
    truth = {d: q == 1 and t == 0 for d, q, t in labels if d >= 400}
    right = sum(out[d]["c5"] == "extra" and out[d]["kept"] == keep for d, keep in truth.items())
    assert right >= 0.97 * len(truth)
    kept = C.keep_good(df, known)
    assert kept.columns == df.columns
    assert all(r["c0"] is None or 0 <= r["score"] <= 1 for r in out.values())


def test_empty_tables_and_missing_metadata(spark):
    data, labels = rows(60)
    df = spark.createDataFrame([r[:2] for r in data], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert C.classified(df.limit(0), known).count() == 0
    assert C.classified(df, known).count() == 60
    assert C.classified(df, known.limit(0)).count() == 60
