import hashlib
import zlib

import pytest

from tidemark.llm import media_columns as M

HTML = '<html><head><title>no</title></head><body>Hi &amp; <b>bold</b><p>one</p><figure><img src="sha256:aa" alt="x"><figcaption>the  caption</figcaption></figure><script>var x = "<p>";</script>two<br>three<video src="v.mp4"/></body></html>'


def test_elements_keep_order_and_captions():
    assert M.parse_html(HTML) == [
        (0, "text", "Hi & bold", None, None),
        (1, "text", "one", None, None),
        (2, "image", None, "sha256:aa", "the caption"),
        (3, "text", "two", None, None),
        (4, "text", "three", None, None),
        (5, "video", None, "v.mp4", None),
    ]
    assert M.parse_html(None) == [] == M.parse_html("")


def test_open_heads_and_captions_in_front():
    assert M.parse_html("<head><title>t</title><meta x><p>one</p>") == [(0, "text", "one", None, None)]
    assert M.parse_html("<head><title>t</title></head>body") == [(0, "text", "body", None, None)]
    assert M.parse_html("<figure><figcaption>c</figcaption><img src=a alt=x></figure>after") == [(0, "image", None, "a", "c"), (1, "text", "after", None, None)]
    assert M.parse_html("<figure><figcaption>alone</figcaption></figure><img src=b>") == [(0, "text", "alone", None, None), (1, "image", None, "b", None)]
    assert M.parse_html("<figure><figcaption>open") == [(0, "text", "open", None, None)]


def test_stored_bytes_are_what_is_measured(spark):
    texts = ["a", "a ", "a", None, "", "x" * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    made = {r["doc_id"]: r for r in M.text_pages(df).collect()}
    assert made[0]["digest"] == made[2]["digest"] != made[1]["digest"] and made[2]["media"] is None
    table = spark.createDataFrame([(r["digest"], bytes(r["media"])) for r in made.values() if r["media"] is not None], "digest string, media binary")
    got = {r["digest"]: r for r in M.measured(table).collect()}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        assert (made[i]["digest"], len(raw)) == (got[made[i]["digest"]]["media_sha256"], got[made[i]["digest"]]["n_bytes"])
    damaged = table.selectExpr("digest", "concat(substring(media, 1, 60), X'00', substring(media, 62)) AS media")
    with pytest.raises(Exception):
        M.measured(damaged).collect()


def plain_feature(samples):
    mean = sum(samples) / len(samples)
    std = (sum((x - mean) ** 2 for x in samples) / len(samples)) ** 0.5
    cuts = [i * len(samples) // 64 for i in range(65)]
    bits = "".join(str(int(sum(samples[a:b]) / (b - a) > mean)) for a, b in zip(cuts, cuts[1:]))
    return f"png;rows={len(samples) // 192};mean={mean:.4f};std={std:.4f};hash={int(bits, 2):016x}"


@pytest.mark.parametrize("raw", [b"", b"abc" * 300, bytes(range(256)) * 7])
def test_features_match_a_plain_computation(raw):
    assert M.sample_features(M.padded(raw)) == plain_feature(M.padded(raw))


@pytest.mark.parametrize("raw", [b"", b"a", b"x" * 192, b"y" * 193, bytes(range(1, 200)) * 50])
def test_exact_round_trip(raw):
    payload = M.padded(raw)
    assert len(payload) % 192 == 0 and payload and payload.rstrip(b" ") == raw.rstrip(b" ") and len(payload) - len(raw) < 193
    assert M.read_png(M.store_png(payload)) == payload


def test_resolve_joins_by_digest(spark):
    pages = spark.createDataFrame([(1, HTML, "k"), (2, None, "k"), (1, HTML, "k")], "page_id long, html string, digest string")
    media = spark.createDataFrame([("aa", b"payload")], "digest string, payload binary")
    got = sorted((tuple(r) for r in M.resolve(M.sequences(pages, "page_id"), media, "page_id").select("page_id", "position", "kind", "caption", "payload").where("kind <> 'text'").collect()), key=str)
    assert got == [(1, 2, "image", "the caption", b"payload")] * 2 + [(1, 5, "video", None, None)] * 2


def test_query_digests(spark, tmp_path):
    rows = [(1, "héllo", 1), (2, None, 2), (3, "", 3), (4, "héllo", 4), (5, "w " * 50_000, 5), (5, "w " * 50_000, 5)]
    spark.createDataFrame(rows, "doc_id long, text string, digest long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in M.op10_media_columns(spark, str(tmp_path)).collect()}
    assert len(got) == 5
    for d, text, _ in rows:
        payload = M.padded((text or "").encode())
        assert got[d]["payload_sha256"] == hashlib.sha256(payload).hexdigest() and got[d]["tail_crc32"] == zlib.crc32(payload[-16:])
        assert (got[d]["n_bytes"], got[d]["payload_bytes"]) == (len((text or "").encode()), len(payload))
        assert got[d]["feature"] == plain_feature(payload)
        stored = M.store_png(payload, length=len((text or "").encode()))
        assert (got[d]["media_bytes"], got[d]["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
    assert got[1].asDict() | {"doc_id": 4} == got[4].asDict()
    many = M.op10_media_columns(spark, str(tmp_path)).collect()
    assert len(many) == len(rows)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "e" / "documents.parquet"))
    assert M.op10_media_columns(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("per_folder,hot", [(3, 10_000), (1, 4)])
def test_many_folders_and_hot_digests_give_the_same_rows(spark, tmp_path, monkeypatch, per_folder, hot):
    rows = [(i, f"text {i % 7}" if i % 3 else "the same") for i in range(60)] + [(60, None), (61, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted(map(str, M.op10_media_columns(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(M, "PER_FOLDER", per_folder)
    monkeypatch.setattr(M, "HOT_SHARE", hot)
    assert sorted(map(str, M.op10_media_columns(spark, str(tmp_path)).collect())) == want and len(want) == len(rows)
