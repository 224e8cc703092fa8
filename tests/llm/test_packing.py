import collections
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import packing as P

TEXTS = ["", None, "a", "Hello  world\n\n foo's bar 12,5\t x", "<|endoftext|> é ü 漢字   x ", "word " * 3000, "   ", "\n \n", "x" * 5000, "don't DON'T we'll", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext"]


def library_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.default_tokenizer())
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_those_of_the_library(text):
    assert np.frombuffer(P.encoder_of(P.default_tokenizer()).encode([text or ""])[0], "<u4").tolist() == library_ids(text)


def test_special_tokens_are_the_librarys_or_ordinary_text():
    text = "a <|endoftext|> b"
    assert 50256 in np.frombuffer(P.RankEncoder(P.default_tokenizer()).encode([text])[0], "<u4")
    assert 50256 not in np.frombuffer(P.RankEncoder(P.default_tokenizer(), special_as_text=True).encode([text])[0], "<u4")


def test_pieces_and_places(spark):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 3)] + [(100 + i, "ab cd " * (i % 90), 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = P.pack_documents(df, P.default_tokenizer()).collect()
    by_doc = collections.Counter(d for d, _, _ in rows)
    for d, text, _ in rows:
        ids = [*library_ids(text), 2]
        mine = sorted((r for r in got if r["doc_id"] == d), key=lambda r: (r["piece"], r["sequence_id"], r["offset"]))[:: by_doc[d]]
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(ids)
        if len(ids) <= 1024:
            assert len(mine) == 1
        assert all(r["length"] == 1024 for r in mine[1:])
        for r in mine:
            part = np.asarray(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 1024) + 1
    assert P.pack_documents(df.limit(0), P.default_tokenizer()).count() == 0


def test_solver_reaches_the_bound_or_best_fit():
    rng = random.Random(5)
    for n in (1, 5, 60, 500):
        sizes = [min(1024, int(rng.expovariate(1 / 300)) + 1) for _ in range(n)]
        patterns = P.solve(collections.Counter(sizes))
        assert sorted(s for p, k in patterns for s in p * k) == sorted(sizes)
        assert all(sum(p) <= 1024 for p, _ in patterns)
        rooms = []
        for s in sorted(sizes, reverse=True):
            fits = [i for i, r in enumerate(rooms) if r >= s]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= s
            else:
                rooms.append(1024 - s)
        assert sum(k for _, k in patterns) <= len(rooms)


def test_solver_with_few_lengths():
    assert sum(k for _, k in P.solve({600: 3, 424: 3, 500: 2, 24: 2})) == 5
    assert P.solve({}) == []


def fewest(sizes, capacity):
    """Brute force over all ways to put sizes into sequences."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            place(i + 1, [r - sizes[i] * (j == k) for j, r in enumerate(rooms)])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def test_solver_backtracks_between_sequences():
    sizes = [992, 736, 608, 608, 352, 224, 192, 160, 128, 64, 32]
    assert sum(k for _, k in P.greedy(collections.Counter(sizes))) > sum(k for _, k in P.solve(collections.Counter(sizes))) == 4
    rng = random.Random(9)
    for _ in range(150):
        sizes = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 11))), reverse=True)
        patterns = P.solve(collections.Counter(sizes), 30)
        assert sorted((s for p, k in patterns for s in p * k), reverse=True) == sizes and all(sum(p) <= 30 for p, _ in patterns)
        assert sum(k for _, k in patterns) == fewest(sizes, 30)
