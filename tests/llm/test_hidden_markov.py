import collections
import math
import random
import re
import zlib

import numpy as np

from tidemark.llm import hidden_markov as H


def plain_forward(symbols, start, transition, emission):
    alpha, log = start, 0.0
    for s in symbols:
        alpha = (alpha @ transition) * emission[s]
        log += math.log(alpha.sum())
        alpha = alpha / alpha.sum()
    return log


def plain_counts(seqs, start, transition, emission):
    size, states = emission.shape
    started, moved, emitted = np.zeros(states), np.zeros((states, states)), np.zeros((size, states))
    for seq in seqs:
        alphas, alpha = [start], start
        for s in seq:
            alpha = (alpha @ transition) * emission[s]
            alpha = alpha / alpha.sum()
            alphas.append(alpha)
        beta = np.ones(states)
        for t in range(len(seq) - 1, -1, -1):
            joint = alphas[t][:, None] * transition * (emission[seq[t]] * beta)[None]
            joint /= joint.sum()
            moved += joint
            emitted[seq[t]] += joint.sum(axis=0)
            if t == 0:
                started += joint.sum(axis=1)
            beta = transition @ (emission[seq[t]] * beta)
            beta /= beta.sum()
    return started, moved, emitted


def sequences(seed, lengths, size):
    rng = np.random.default_rng(seed)
    seqs = [rng.integers(0, size, n) for n in lengths]
    return seqs, np.concatenate(seqs), np.concatenate([[0], np.cumsum(lengths)])


def test_blocks_give_the_exact_likelihood_and_counts():
    seqs, flat, starts = sequences(1, [1, 5, 7, 40, 3, 23, 8, 1, 16], 12)
    start, model = H.initial_model(np.full(12, 1 / 12), 3, 5)
    got = H.sequence_log_likelihood(flat, starts, model, start, block=8)
    assert np.allclose(got, [plain_forward(s, start, *model) for s in seqs])
    s, m, e, fit = H.expected_counts(flat, starts, model, start, 12, block=8)
    want = plain_counts(seqs, start, *model)
    assert np.allclose(s, want[0]) and np.allclose(m, want[1]) and np.allclose(e, want[2])
    assert math.isclose(fit, got.sum())


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(2)
    seqs = [np.concatenate([rng.integers(0, 6, 30), rng.integers(6, 12, 30)]) for _ in range(40)]
    flat, starts = np.concatenate(seqs), np.arange(41) * 60
    unigram = np.full(12, 1 / 12)
    start, model = H.initial_model(unigram, 3, 5)
    fits = []
    for _ in range(12):
        s, m, e, fit = H.expected_counts(flat, starts, model, start, 12)
        fits.append(fit)
        start, model = H.renewed(s, m, e, unigram, smoothing=1.0)
    assert fits[-1] > fits[0] + 100 and fits[-1] > 2400 * math.log(1 / 12)


def base(rows):
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for i, (_, t) in enumerate(rows)}
    held = {i: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    count = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    return [(d, held[i], len(words[i]), sum(count[w] > 0 for w in words[i]), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words[i])) for i, (d, _) in enumerate(rows)]


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(120):
        lang = rng.randrange(3)
        rows.append((i, " ".join(f"L{lang}w{min(int(rng.expovariate(0.05)), 400)}" for _ in range(rng.randint(1, 700)))))
    return rows + [(500, None), (501, ""), (502, " \n"), (7, rows[7][1]), (None, "x y")]


def test_base_columns_and_gain_over_the_base(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, h long, held_out string")
    got = sorted((tuple(r) for r in H.language_model_scores(df, own=20, frequent=50, classes=8).collect()), key=lambda r: (str(r[:3])))
    want = sorted(base(rows), key=lambda r: str(r[:3]))
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)
    assert H.language_model_scores(df.limit(0)).count() == 0


def test_model_rows_are_distributions():
    start, (transition, emission) = H.initial_model(np.full(5, 0.2), 4, 1)
    assert np.allclose(emission.sum(axis=0), 1) and np.allclose(transition.sum(axis=1), 1) and math.isclose(start.sum(), 1)
