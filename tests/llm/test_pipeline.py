import random
import re

import corpus_pipeline as P
from tests.llm.test_jaccard_join import brute
from tidemark.llm.packing import default_tokenizer


def corpus(tmp_path, spark):
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(500)}" for _ in range(70))
    rows, labels = [], []
    for i in range(260):
        kind = i % 10
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(40, 120))]
        if kind == 7:
            words = [w + "$$" for w in words]
        if kind == 8:
            words[3] = words[20] = "nastyword"
        text = " ".join(words)
        if kind == 5 and rows:
            text = rows[rng.randrange(len(rows))][1] + " tail"
        if kind == 6:
            text = text + "\n" + passage + "\n" + text[:50]
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, int(kind != 7), int(kind == 8)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return rows, passage


def test_stages_take_effect(spark, tmp_path):
    rows, passage = corpus(tmp_path, spark)
    docs, state = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        state[name] = docs
        if name != P.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r["doc_id"]: r["text"] for r in state["quality classifier"].collect()}
    assert not [d for d in kept if d % 10 in (7, 8)]
    assert all(d in kept for d, text, *_ in rows if not re.search(r"\$|nasty", text))
    ruled = {r["doc_id"]: r["text"] for r in state["quality rules"].collect()}
    assert set(ruled) <= set(kept) and len(ruled) > 0.9 * len(kept)
    single = {r["doc_id"] for r in state["n-gram Jaccard join"].collect()}
    assert single == {c for _, _, c in brute(sorted(ruled.items()))}
    cut = {r["doc_id"]: r for r in state["suffix-array dedup"].collect()}
    assert set(cut) == single and not any(passage in r["text"] for r in cut.values())
    assert all(r["n_chars"] == len(r["text"]) for r in cut.values())
    packed = state["best-fit packing"]
    assert {r["doc_id"] for r in packed.collect()} == single
    assert default_tokenizer()


def test_run_returns_the_last_stage(spark, tmp_path):
    corpus(tmp_path, spark)
    out = P.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100


ODD = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, h1 long, kept boolean, component string"


def odd_rows():
    rng = random.Random(2)
    text = lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(60))
    one = text()
    rows = [(i, text(), "en", "s", 300, "x", i, True, "c") for i in range(60)]
    rows += [(100, None, None, None, None, None, None, None, None), (101, "", "en", None, 0, "x", 1, False, ""), (None, text(), "en", "s", 1, "x", 1, True, "")]
    rows += [(102, one, "en", "s", 300, "x", 1, True, "c")] * 2 + [(103, one + " more", "de", "s", 300, "y", 2, True, "c"), (103, text(), "de", "s", 300, "z", 2, True, "c"), (104, "long " + " ".join(f"v{i}" for i in range(30_000)), "en", "s", 0, "x", 0, True, "c")]
    return rows


def test_stages_with_odd_rows_clashing_columns_and_an_empty_table(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame([(i, 1, 0) for i in range(0, 40)] + [(None, 1, 0), (5, None, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(rows, ODD)
    columns, sizes = docs.columns, [len(rows)]
    for number, (name, stage) in enumerate(P.STAGES):
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / f"stage{number}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns == empty.columns
            ids = [r["doc_id"] for r in docs.collect()]
        if name == "quality classifier":
            assert sizes[-1] == len(rows)  # nothing but good labels: nothing is rejected
        if name == "quality rules":
            assert sorted(ids, key=str) == sorted((r[0] for r in rows if r[1]), key=str)
        if name == "n-gram Jaccard join":
            # 102 twice and its near copy under 103 are one group; 103's other text is its own.
            assert sorted(ids, key=str) == sorted([*range(60), 102, 103, 104, None], key=str)
    assert {r["doc_id"] for r in docs.collect()} == {*range(60), 102, 103, 104, None}
