"""Quality classifier by co-training of two views.

Two judgements are learned, junk (quality 0) and toxic (toxic 1), each by two logistic classifiers
that see different things: the content view the text alone (its words, and its layout: shares of
symbols, capitals, digits, lines, repeated neighbours), the metadata view the page's columns alone
(language, source, stated length).

1. A bounded sample of labelled rows (the LABELLED with the smallest hash of their id) trains the
   first classifiers. FEATURES words are selected per judgement by their chi-square statistic, which
   Spark counts over the words of all training rows; the driver sees selected words only.
2. In each of ROUNDS rounds every unlabelled document of the corpus is scored by both views, and
   each view hands the other up to PER_ROUND texts, of each class those that it is surest of (at
   least CONFIDENT sure), in the labels' proportion of the classes, so that no class's share shifts. Words are selected anew, so that what the metadata view hands over can bring
   words that no labelled row holds, and both are trained anew on labels and what they were handed.
3. On a fold of the labelled sample that took no part in training, a logistic function calibrates
   and combines the two views of each judgement; a view that would count against itself there is
   left out.
4. All documents are scored: P(not junk) * P(not toxic); those below THRESHOLD are rejected.

Models are tables of bounded size, and what the driver holds of a training row is its features,
whatever the text's length. Rows that are equally sure are ordered by a hash of their text, and rows
of one text (but for case) are handed over once, so neither the order of rows nor copies change the
model. Equal rows get equal scores. Of several labelled rows under one id one is used. Null text:
empty. Null language, source or length: a value of its own. Missing metadata columns count as null.
Without labels of both classes a judgement keeps the prior. Repeated rows come back as often as they
came. Empty table: no rows. Extra columns are ignored by the query and kept by keep_good().
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .scratch import drop, store
from .textkit import LOWER, SPACE, buffers, chunks, documents, find_words, mix, narrow, prefix_hash, span_hash

LABELLED = 8_000
FEATURES = 768
ROUNDS = 2
PER_ROUND = 400
CONFIDENT = 0.95
THRESHOLD = 0.4
MIN_TEXTS = 4
CERTAIN = 12.0
HEADS = ("junk", "toxic")
VIEWS = ("content", "metadata")

_LETTER = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _LETTER[_a : _b + 1] = True
_NOT_LETTER = ~_LETTER
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[0x41:0x5B] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_SYMBOL = ~_LETTER & ~SPACE
_SYMBOL[list(b".,'-")] = False
META_SLOTS = 48
LAYOUT = 8


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (running[offsets[1:]] - running[offsets[:-1]]).astype(np.float64)


def read_views(data, offsets, lang, source, n_chars):
    """Metadata rows, layout rows, hashes of the texts in lower case, word hashes, and the document of each word (words may repeat)."""
    docs = len(offsets) - 1
    starts, ends, first = find_words(data, offsets)
    low = LOWER[data]
    running = prefix_hash(low)
    raw = span_hash(running, starts, ends)
    doc = np.repeat(np.arange(docs), np.diff(first))
    a, b, first_plain = find_words(data, offsets, _NOT_LETTER)
    plain = mix(span_hash(running, a, b) + np.uint64(1))
    n = np.maximum(np.diff(offsets).astype(np.float64), 1.0)
    words = np.maximum(np.diff(first).astype(np.float64), 1.0)
    again = np.zeros(len(raw), dtype=np.int64)
    if len(raw) > 2:
        again[1:] = (raw[1:] == raw[:-1]) & (doc[1:] == doc[:-1])
    meta = np.zeros((docs, META_SLOTS + 1), dtype=np.float64)
    for i, (x, y) in enumerate(zip(lang, source)):
        meta[i, zlib.crc32(f"l{x}".encode()) % 8] = 1.0
        meta[i, 8 + zlib.crc32(f"s{y}".encode()) % (META_SLOTS - 8)] = 1.0
    meta[:, META_SLOTS] = np.log1p(np.asarray([max(c or 0, 0) for c in n_chars], dtype=np.float64))
    layout = np.column_stack([
        np.log1p(words),
        sums(_SYMBOL[data], offsets) / n,
        sums(_CAPITAL[data], offsets) / n,
        sums(_DIGIT[data], offsets) / n,
        sums(data == 0x0A, offsets) / words,
        sums(data == 0x7C, offsets) / words,
        n / words / 10,
        np.bincount(doc, weights=again, minlength=docs) / words,
    ])
    text = span_hash(running, offsets[:-1], offsets[1:])
    return meta, layout, text, np.concatenate([raw, plain]), np.concatenate([doc, np.repeat(np.arange(docs), np.diff(first_plain))])


def batch_views(batch: pa.RecordBatch, at: dict[str, int]):
    """(first document, end, metadata, layout, text hashes, word hashes, documents of the words) by chunks."""
    data, offsets = buffers(batch.column(at["text"]))
    other = {k: batch.column(at[k]).to_pylist() if k in at else [None] * batch.num_rows for k in ("lang", "source", "n_chars")}
    for start, end, part, where in chunks(data, offsets):
        yield (start, end, *read_views(part, where, other["lang"][start:end], other["source"][start:end], other["n_chars"][start:end]))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 120) -> np.ndarray:
    """Weights (bias last) by accelerated gradient steps."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float32)
    penalty = np.full(x.shape[1], ridge, dtype=np.float32)
    penalty[-1] = 1e-3
    v = np.ones(x.shape[1], dtype=np.float32)
    top = 1.0
    for _ in range(10):
        v = x.T @ (x @ v)
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 1.0 / (0.25 * top + ridge)
    w = previous = np.zeros(x.shape[1], dtype=np.float32)
    for k in range(steps):
        z = w + (k / (k + 3)) * (w - previous)
        p = 1 / (1 + np.exp(-np.clip(x @ z, -30, 30)))
        previous, w = w, z - rate * (x.T @ (p - y) + penalty * z)
    return w.astype(np.float64)


class Views:
    """The two classifiers of each judgement, and how they are combined."""

    def __init__(self, centre: np.ndarray, width: np.ndarray):
        self.vocabulary = np.zeros(0, dtype=np.uint64)
        #: Of each judgement, the places of its words in the joint vocabulary.
        self.own: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(HEADS)
        self.centre, self.width = centre, width  # of metadata and layout
        self.weights: dict[tuple[str, str], np.ndarray] = {}
        self.combined = {h: np.asarray([0.5, 0.5, 0.0]) for h in HEADS}
        #: Log odds of each judgement among the labelled rows.
        self.prior = dict.fromkeys(HEADS, 0.0)

    def hits(self, words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, feature) pairs of selected words."""
        if not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == words
        key = np.unique(doc[hit] * len(self.vocabulary) + at[hit])
        return key // len(self.vocabulary), key % len(self.vocabulary)

    def scaled(self, meta: np.ndarray, layout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = META_SLOTS + 1
        return (meta - self.centre[:m]) / self.width[:m], (layout - self.centre[m:]) / self.width[m:]

    def logits(self, meta: np.ndarray, layout: np.ndarray, doc: np.ndarray, feature: np.ndarray) -> dict[tuple[str, str], np.ndarray]:
        """Content weights: a word of the vocabulary each, then layout, then the bias."""
        out, (meta, layout) = {}, self.scaled(meta, layout)
        for (head, view), w in self.weights.items():
            if view == "content":
                out[head, view] = np.bincount(doc, weights=w[feature], minlength=len(meta)) + layout @ w[-1 - LAYOUT : -1] + w[-1]
            else:
                out[head, view] = meta @ w[:-1] + w[-1]
        return out

    def probability(self, logits: dict, head: str) -> np.ndarray:
        c = self.combined[head]
        return 1 / (1 + np.exp(-np.clip(c[0] * logits[head, "content"] + c[1] * logits[head, "metadata"] + c[2], -30, 30)))


def labelled_sample(labels: DataFrame, limit: int) -> dict:
    rows = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return {r[0]: (1 - r[1], r[2]) for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()}


EXAMPLE = ["round", "id", "text", "side", "meta", "layout", "words"]


def side_hash(meta: np.ndarray) -> np.ndarray:
    """Hash of each row's metadata."""
    return np.asarray([zlib.crc32(m.tobytes()) for m in meta], dtype=np.int64)


def example_rows(rows: DataFrame, at: dict[str, int], wanted: set, number: int) -> DataFrame:
    """Training rows (round `number`): metadata, layout and distinct words of the rows whose id is wanted, one row an id and text."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)  # LABELLED ids at most, or what a round hands over
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [i for i, x in enumerate(batch.column(at["doc_id"]).to_pylist()) if x in shared.value]
            if not found:
                continue
            part = batch.take(pa.array(found, pa.int64()))
            for start, end, meta, layout, text, words, doc in batch_views(part, at):
                order = np.argsort(doc, kind="stable")
                cuts = np.searchsorted(doc[order], np.arange(1, end - start))
                mine = [np.unique(w).tobytes() for w in np.split(words[order], cuts)]
                ids = part.column(at["doc_id"]).slice(start, end - start)
                blobs = ([x.tobytes() for x in table] for table in (meta, layout))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(end - start, number, np.int32)), ids, pa.array(text.view(np.int64)), pa.array(side_hash(meta)), *(pa.array(x, pa.binary()) for x in blobs), pa.array(mine, pa.binary())], names=EXAMPLE)

    found = rows.mapInArrow(run, f"round int, id {id_type}, text long, side long, meta binary, layout binary, words binary")
    one = F.min(F.struct("side", "layout", "meta", "words")).alias("one")
    return found.groupBy("round", "id", "text").agg(one).select("round", "id", "text", "one.side", "one.meta", "one.layout", "one.words")


def selected_words(examples: DataFrame, answers: dict) -> list[np.ndarray]:
    """Of each judgement, the FEATURES words whose presence depends most on the class (chi-square).

    `answers`: of (round, id, text), each judgement's class, or -1 where the row doesn't train it."""
    spark = examples.sparkSession
    shared = spark.sparkContext.broadcast(answers)  # an entry a training row

    def run(batches):
        for batch in batches:
            held, marks = [], []
            for key, words in zip(zip(*(batch.column(c).to_pylist() for c in range(3))), batch.column(3)):
                if (y := shared.value.get(key)) is not None:
                    held.append(np.frombuffer(words.as_buffer(), dtype=np.uint64))
                    marks.append(y)
            if held:
                values, place = np.unique(np.concatenate(held), return_inverse=True)
                y = np.repeat(np.asarray(marks), [len(w) for w in held], axis=0)
                counts = [np.bincount(place, weights=flags, minlength=len(values)).astype(np.int64) for k in range(len(HEADS)) for flags in (y[:, k] >= 0, y[:, k] == 1)]
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), *map(pa.array, counts)], names=names)

    names = ["h", *(f"{x}{k}" for k in range(len(HEADS)) for x in ("n", "a"))]
    counts = examples.select("round", "id", "text", "words").mapInArrow(run, ", ".join(f"{n} long" for n in names)).groupBy("h").agg(*(F.sum(n).alias(n) for n in names[1:]))
    counts, path = store(counts.where(" OR ".join(f"n{k} >= {MIN_TEXTS}" for k in range(len(HEADS)))))
    out = []
    for k in range(len(HEADS)):
        y = np.asarray([v[k] for v in answers.values() if v[k] >= 0])
        total, positive = len(y), int(y.sum())
        if not 0 < positive < total:
            out.append(np.zeros(0, dtype=np.uint64))
            continue
        seen, a, share = F.col(f"n{k}"), F.col(f"a{k}"), positive / total
        expected = seen * share
        score = (a - expected) * (a - expected) / F.greatest(expected * (1 - share) * (1 - seen / total), F.lit(1e-9))
        best = counts.where((seen >= MIN_TEXTS) & (seen < total)).select("h", score.alias("score")).where(F.col("score") > CERTAIN).orderBy(F.desc("score"), "h").limit(FEATURES)
        out.append(np.sort(best.toArrow().column("h").to_numpy().view(np.uint64)))
    drop(spark, path)
    return out


def example_features(examples: DataFrame, vocabulary: np.ndarray) -> dict:
    """(round, id, text): metadata, layout and the places of its words in the vocabulary, for every training row."""
    shared = examples.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            hits = [np.flatnonzero(np.isin(shared.value, np.frombuffer(w.as_buffer(), dtype=np.uint64), assume_unique=True)).astype("<u2").tobytes() for w in batch.column(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(hits, pa.binary())], names=names)

    names = ["round", "id", "text", "meta", "layout", "hits"]
    id_type = examples.schema["id"].dataType.simpleString()
    table = examples.select("round", "id", "text", "meta", "layout", "words").mapInArrow(run, f"round int, id {id_type}, text long, meta binary, layout binary, hits binary").toArrow()
    out = {}
    for *key, meta, layout, hits in zip(*(table.column(n).to_pylist() for n in names)):
        out[tuple(key)] = np.frombuffer(meta), np.frombuffer(layout), np.frombuffer(hits, "<u2")
    return out


class Training:
    """Labelled rows, the rows handed over in this round, and the classifiers that they make."""

    def __init__(self, rows: DataFrame, at: dict[str, int], labels: DataFrame):
        self.rows, self.at = rows, at
        self.named = labelled_sample(labels, LABELLED)
        self.labelled, self.path = store(example_rows(rows, at, set(self.named), 0))
        self.keys = self._one_an_id(self.labelled.select("round", "id", "text").collect())
        self.y = np.asarray([self.named[k[1]] for k in self.keys], dtype=np.float64).reshape(-1, len(HEADS))
        self.held = np.asarray([zlib.crc32(f"fold{k[1]}".encode()) % 4 == 0 for k in self.keys], dtype=bool)
        self.views = self._scales()
        self.train({}, None)

    @staticmethod
    def _one_an_id(keys) -> list[tuple]:
        lowest = {}
        for number, i, text in keys:
            lowest[i] = min(lowest.get(i, text), text)
        return [(0, i, lowest[i]) for i in sorted(lowest)]

    def _scales(self) -> Views:
        found = example_features(self.labelled, np.zeros(0, dtype=np.uint64))
        fit = [np.concatenate(found[k][:2]) for k, h in zip(self.keys, self.held) if not h]
        wide = np.asarray(fit).reshape(len(fit), META_SLOTS + 1 + LAYOUT) if fit else np.zeros((1, META_SLOTS + 1 + LAYOUT))
        spread = wide.std(axis=0)
        return Views(wide.mean(axis=0), np.where(spread > 1e-9, spread, 1.0))

    def train(self, handed: dict, extra: DataFrame | None) -> None:
        """Selects words and fits all classifiers; handed: (judgement, view) -> [(key, class)], rows of `extra`."""
        examples = self.labelled if extra is None else self.labelled.union(extra)
        answers = {k: tuple(y.astype(int).tolist()) for k, y, h in zip(self.keys, self.y, self.held) if not h}
        for number, head in enumerate(HEADS):
            for key, y in handed.get((head, "content"), ()):
                own = list(answers.get(key, (-1,) * len(HEADS)))
                own[number] = y
                answers[key] = tuple(own)
        views = self.views
        chosen = selected_words(examples, answers)
        views.vocabulary = np.unique(np.concatenate(chosen))
        views.own = [np.searchsorted(views.vocabulary, c) for c in chosen]
        found = example_features(examples, views.vocabulary)
        for number, head in enumerate(HEADS):
            y = self.y[~self.held, number]
            views.prior[head] = float(np.log((y.sum() + 0.05) / (len(y) - y.sum() + 0.95)))
            for view in VIEWS:
                more = handed.get((head, view), ())
                keys = [k for k, h in zip(self.keys, self.held) if not h] + [k for k, _ in more]
                target = np.concatenate([y, np.asarray([c for _, c in more], dtype=np.float64)])
                size = len(views.vocabulary) + LAYOUT if view == "content" else META_SLOTS + 1
                whole = np.zeros(size + 1)
                if 0 < y.sum() < len(y):
                    own = np.concatenate([views.own[number], len(views.vocabulary) + np.arange(LAYOUT)]) if view == "content" else np.arange(size)
                    fitted = fit_logistic(self.matrix(found, keys, view, own), target)
                    whole[own], whole[-1] = fitted[:-1], fitted[-1]
                else:
                    whole[-1] = views.prior[head]
                views.weights[head, view] = whole
        self.found = {k: found[k] for k in self.keys}

    def matrix(self, found: dict, keys: list, view: str, own: np.ndarray) -> np.ndarray:
        """The training rows of one classifier; `own`: the places that it sees."""
        views = self.views
        meta, layout = (np.asarray([found[k][i] for k in keys]).reshape(len(keys), n) for i, n in ((0, META_SLOTS + 1), (1, LAYOUT)))
        meta, layout = views.scaled(meta, layout)
        if view == "metadata":
            return meta.astype(np.float32)
        column = np.full(len(views.vocabulary), -1)
        words = own[:-LAYOUT]
        column[words] = np.arange(len(words))
        x = np.zeros((len(keys), len(own)), dtype=np.float32)
        for i, k in enumerate(keys):
            hit = column[found[k][2]]
            x[i, hit[hit >= 0]] = 1
        x[:, len(words) :] = layout
        return x

    def combine(self) -> None:
        """Calibrates and combines the two views on the held fold."""
        keys = [k for k, h in zip(self.keys, self.held) if h]
        for number, head in enumerate(HEADS):
            y = self.y[self.held, number]
            if 0 < y.sum() < len(y):
                pair = []
                for view in VIEWS:
                    w = self.views.weights[head, view]
                    x = self.matrix(self.found, keys, view, np.concatenate([self.views.own[number], len(self.views.vocabulary) + np.arange(LAYOUT)]))
                    own = np.concatenate([self.views.own[number], np.arange(len(w) - 1 - LAYOUT, len(w) - 1)]) if view == "content" else np.arange(len(w) - 1)
                    pair.append(x @ w[own] + w[-1])
                pair, whole = np.column_stack(pair), np.zeros(len(VIEWS) + 1)
                fitted = fit_logistic(pair, y, ridge=0.1, steps=2000)
                own = np.append(fitted[:-1] > 0, True)
                whole[own] = fitted if own.all() else fit_logistic(pair[:, own[:-1]], y, ridge=0.1, steps=2000)
                self.views.combined[head] = whole


def foremost(sure: np.ndarray, text: np.ndarray, side: np.ndarray, top: int) -> np.ndarray:
    """Places of the `top` surest rows with different texts; ties go by the hashes of text and metadata."""
    order = np.lexsort((side, text, -sure))
    _, first = np.unique(text[order], return_index=True)
    return order[np.sort(first)[:top]]


def handed_share(prior: float, per_round: int) -> tuple[int, int]:
    """How many texts of the negative and the positive class a view hands over: as the labels have them."""
    positive = min(max(1, round(per_round / (1 + np.exp(-prior)))), per_round - 1)
    return per_round - positive, positive


def in_proportion(chosen: list, shares: list[tuple[int, int]]) -> list:
    """Of the rows (slot, place, ..) of each view and judgement the foremost, both classes in the labels' proportion: none if one class has none."""
    found = np.bincount([r["slot"] for r in chosen], minlength=2 * len(shares)).reshape(-1, 2)
    part = [min(n / s for n, s in zip(*pair)) for pair in zip(found.tolist(), shares)]
    limits = [min(1.0, p) * s for p, share in zip(part, shares) for s in share]
    return [r for r in chosen if r["place"] <= limits[r["slot"]] + 1e-9]


def surest(rows: DataFrame, at: dict[str, int], views: Views, labelled: set, per_slot: int) -> DataFrame:
    """slot, margin, text, side, id: of each partition the surest unlabelled texts of each view, judgement and class."""
    shared = rows.sparkSession.sparkContext.broadcast((views, labelled))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    margin = float(np.log(CONFIDENT / (1 - CONFIDENT)))

    def run(batches):
        model, skip = shared.value
        quota = [handed_share(model.prior[head], per_slot) for head, _ in model.weights]
        best: dict[int, tuple] = {}
        for batch in batches:
            ids = batch.column(at["doc_id"]).to_pylist()
            for start, end, meta, layout, text, words, doc in batch_views(batch, at):
                free = np.asarray([i is not None and i not in skip for i in ids[start:end]], dtype=bool)
                side = side_hash(meta)
                for slot, z in enumerate(model.logits(meta, layout, *model.hits(words, doc)).values()):
                    for sign in (0, 1):
                        sure = z if sign else -z
                        some = np.flatnonzero(free & (sure >= margin))
                        new = sure[some], text[some], side[some], np.asarray([ids[start + k] for k in some.tolist()], dtype=object)
                        old = best.get(2 * slot + sign)
                        both = new if old is None else tuple(np.concatenate(x) for x in zip(old, new))
                        keep = foremost(*both[:3], quota[slot][sign])
                        best[2 * slot + sign] = tuple(x[keep] for x in both)
        for slot, (sure, text, side, ids) in best.items():
            if len(sure):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sure), slot, np.int32)), pa.array(sure), pa.array(text.view(np.int64)), pa.array(side), pa.array(ids.tolist(), id_kind)], names=["slot", "margin", "text", "side", "id"])

    id_kind = to_arrow_type(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(run, f"slot int, margin double, text long, side long, id {id_type}")


def train_views(rows: DataFrame, at: dict[str, int], labels: DataFrame, rounds: int = ROUNDS) -> Views:
    training = Training(rows, at, labels)
    slots = list(training.views.weights)
    for number in range(1, rounds + 1) if len(training.y) else ():
        found = surest(rows, at, training.views, set(training.named), PER_ROUND)
        one = found.groupBy("slot", "text").agg(F.min(F.struct((-F.col("margin")).alias("less"), "side", "id")).alias("one")).select("slot", "text", "one.*")
        for group in (["slot", F.pmod("text", F.lit(64))], ["slot"]):  # in parts first, so that no task reads all of a slot
            one = one.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy("less", "text"))).where(F.col("place") <= PER_ROUND)
        chosen = one.select("slot", "place", "text", "id").collect()  # PER_ROUND rows a slot
        chosen = in_proportion(chosen, [handed_share(training.views.prior[head], PER_ROUND) for head, _ in slots])
        extra, path = store(example_rows(rows, at, {r["id"] for r in chosen}, number))
        handed: dict[tuple[str, str], list] = {}
        for slot, _, text, i in sorted(map(tuple, chosen)):
            head, view = slots[slot // 2]
            handed.setdefault((head, "metadata" if view == "content" else "content"), []).append(((number, i, text), slot % 2))
        training.train(handed, extra)
        drop(rows.sparkSession, path)
    training.combine()
    drop(rows.sparkSession, training.path)
    return training.views


def classified(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of `docs` (as c0..), then p_junk, p_toxic, score and kept."""
    names = docs.columns
    known = [n for n in ("doc_id", "text", "lang", "source", "n_chars") if n in names]
    rows = narrow(docs, *known)
    views = train_views(rows, {n: i for i, n in enumerate(known)}, labels, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(views)
    at = {n: names.index(n) for n in known}
    wide = docs.toDF(*(f"c{i}" for i in range(len(names))))
    schema = StructType(list(wide.schema.fields)).add("p_junk", "double").add("p_toxic", "double").add("score", "double").add("kept", "boolean")

    def run(batches):
        model = shared.value
        for batch in batches:
            for start, end, meta, layout, _, words, doc in batch_views(batch, at):
                logits = model.logits(meta, layout, *model.hits(words, doc))
                junk, toxic = (model.probability(logits, h) for h in HEADS)
                score = (1 - junk) * (1 - toxic)
                yield pa.RecordBatch.from_arrays([*batch.slice(start, end - start).columns, pa.array(junk), pa.array(toxic), pa.array(score), pa.array(score >= threshold)], names=schema.names)

    return wide.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not rejected, with their columns."""
    return classified(docs, labels).where("kept").select(*(f"c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


def op4_cotraining(spark, sf_dir):
    docs = narrow(documents(spark, sf_dir), "doc_id", "text", "lang", "source", "n_chars")
    return classified(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(F.col("c0").alias("doc_id"), "p_junk", "p_toxic", "score", "kept")
