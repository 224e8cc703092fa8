"""Hidden Markov language model over whole texts.

Symbols: the OWN most frequent training words have a symbol each; every other word falls by its
hash into one of CLASSES classes, inside which a word has probability (count + 1) / class total,
the class total holding one more outcome for words never seen; the end of a text is a symbol. So
the model is a distribution over texts of any vocabulary, with a bounded number of parameters, and

    log P(text) = log P(symbol sequence | HMM) + sum over words of log P(word | class).

The first term comes from the scaled forward recursion over the broadcast model (its size depends
on the parameters above, not on the corpus). The second is additive over words: rare words meet
their counts in a join on the word's hash, frequent ones have none.

Once the symbols are known, one pass over the texts writes a table in the shared folder: what the
bounded tables say of each row, its rare words, and the symbol sequences, packed. The rounds and the
final forward pass read the sequences and never see a text.

Training is Baum-Welch: each partition runs forward and backward over all its training sequences and
emits expected counts per symbol, which Spark sums; a round is one job. Long texts are cut into
blocks whose transfer matrices are computed side by side, so that a long text doesn't make a
long chain of small steps; the matrices carry the exact forward and backward vectors over the cuts.

Words are told apart by 64-bit hashes. Null and empty texts: only the end token. Repeated rows
count and come back as often as they came. A null id counts as training. Empty table: no rows.
Extra columns are ignored. Without training tokens the base is over one unseen outcome.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop, store
from .textkit import LOWER, buffers, chunks, cut, documents, mix, narrow, word_hashes

STATES = 8
ROUNDS = 4
OWN = 1 << 15
CLASSES = 1 << 12
FREQUENT = 1 << 17
BLOCK = 1024
RESCALE = 16
SMOOTHING = 2000.0
SEED = 11
CHUNK = 4 << 20
FLUSH_WORDS = 400_000


def held_out_column(name: str = "id"):
    return F.coalesce(F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def batch_words(column: pa.Array):
    """(first document, word hashes, first word of each document) by chunks of a column of texts."""
    data, offsets = buffers(column)
    for first, _, part, at in chunks(data, offsets, CHUNK):
        yield (first, *word_hashes(LOWER[part], at))


def word_counts(rows: DataFrame) -> DataFrame:
    """h, c: training words and their counts."""

    def run(batches):
        held, size = [], 0

        def flush():
            values, place = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([c for _, c in held])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["h", "c"])

        for batch in batches:
            train = ~np.asarray(batch.column(1).to_pylist(), dtype=bool)
            for first, hashes, at in batch_words(batch.column(0)):
                use = np.repeat(train[first : first + len(at) - 1], np.diff(at))
                values, counts = np.unique(hashes[use], return_counts=True)
                if len(values):
                    held.append((values, counts))
                    size += len(values)
                if size >= FLUSH_WORDS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return rows.select("text", "held_out").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Lexicon:
    """The frequent words, the symbols, and the class totals: all of bounded size."""

    def __init__(self, hashes, counts, own: int, classes: int, class_total, end_count: int, train_tokens: int, distinct: int):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        rank = np.empty(len(order), dtype=np.int64)
        rank[:] = order
        self.own = min(own, len(order))
        self.classes = classes
        # Symbols: 0..own-1 own words, then classes, then the end.
        self.symbol_of = np.where(rank < self.own, rank, -1)
        self.size = self.own + classes + 1
        self.end = self.size - 1
        self.class_total = class_total
        self.end_count, self.train_tokens, self.distinct = end_count, train_tokens, distinct

    def lookup(self, words: np.ndarray):
        """Symbols, counts (-1: not in the table of frequent words), and whether the word has its own symbol."""
        symbols = self.own + (mix(words) >> np.uint64(40)).astype(np.int64) % self.classes
        counts = np.full(len(words), -1, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
            hit = self.hashes[at] == words
            counts[hit] = self.counts[at[hit]]
            own = hit & (self.symbol_of[at] >= 0)
            symbols[own] = self.symbol_of[at[own]]
        return symbols, counts

    def sequences(self, words: np.ndarray, at: np.ndarray):
        """Symbols of each document with its end, document starts, and the counts of its words."""
        symbols, counts = self.lookup(words)
        docs = len(at) - 1
        ends = at[1:] + np.arange(docs)
        out = np.full(len(words) + docs, self.end, dtype=np.int64)
        mask = np.ones(len(out), dtype=bool)
        mask[ends] = False
        out[mask] = symbols
        return out, np.append(at[:-1] + np.arange(docs), len(out)), counts, symbols


class Blocks:
    """Documents' symbol sequences laid out as columns of at most BLOCK steps, longest first."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, block: int):
        length = np.diff(starts)
        count = -(-length // block)
        self.doc = np.repeat(np.arange(len(length)), count)
        step = np.arange(len(self.doc)) - np.repeat(np.cumsum(count) - count, count)
        begin = starts[:-1][self.doc] + step * block
        size = np.minimum(block, starts[1:][self.doc] - begin)
        self.is_first, self.is_last = step == 0, step == count[self.doc] - 1
        self.order = np.argsort(-size, kind="stable")
        self.place = np.empty(len(size), dtype=np.int64)
        self.place[self.order] = np.arange(len(size))
        self._lay(symbols, begin[self.order], size[self.order])

    def _lay(self, symbols: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
        self.symbols, self.begin, self.length = symbols, begin, length
        self.steps = int(length[0]) if len(length) else 0
        self.active = [int(np.searchsorted(-length, -t, side="left")) for t in range(self.steps)]

    def only(self, blocks: np.ndarray) -> tuple["Blocks", np.ndarray]:
        """The columns of some blocks (numbered in document order), and their rows in this layout."""
        rows = np.sort(self.place[blocks])
        part = object.__new__(Blocks)
        part._lay(self.symbols, self.begin[rows], self.length[rows])
        return part, rows


def forward(blocks: Blocks, model, entering: np.ndarray, keep: bool = False):
    """Scaled forward pass of every block from its entering state vectors (blocks x … x states).

    Returns the vectors after the block, the log of their scale, and with `keep` all vectors. Without
    it the vectors are scaled every RESCALE steps, which stays far from the smallest numbers."""
    transition, emission = model
    states = len(transition)
    alpha = entering.copy()
    scale = np.zeros(alpha.shape[:-1])
    kept = []
    for t in range(blocks.steps):
        n = blocks.active[t]
        b = emission[blocks.symbols[blocks.begin[:n] + t]]
        now = (alpha[:n].reshape(-1, states) @ transition).reshape(n, -1, states)  # one product, however many vectors a block has
        now *= b[:, None]
        now = now.reshape(alpha[:n].shape)
        if keep or t % RESCALE == RESCALE - 1:
            total = now.sum(axis=-1)
            now /= total[..., None]
            scale[:n] += np.log(total)
            if keep:
                kept.append((now, total))
        alpha[:n] = now
    if not keep and blocks.steps:
        total = alpha.sum(axis=-1)
        alpha /= total[..., None]
        scale += np.log(total)
    return alpha, scale, kept


def entering_vectors(blocks: Blocks, model, start: np.ndarray):
    """For every block (in document order): the normalised state vector before it, and log scale so far; and the transfer matrices."""
    states = len(start)
    total = len(blocks.doc)
    inner = np.flatnonzero(~blocks.is_last)
    matrices = logs = None
    if len(inner):
        part, rows = blocks.only(inner)
        eye = np.broadcast_to(np.eye(states), (len(rows), states, states)).copy()
        after, scale, _ = forward(part, model, eye)
        number = np.full(total, -1, dtype=np.int64)
        number[blocks.order[rows]] = np.arange(len(rows))
        top = scale.max(axis=1)
        matrices, logs = after * np.exp(scale - top[:, None])[..., None], top
    entering = np.tile(start, (total, 1))
    before = np.zeros(total)
    for i in inner.tolist():  # one short step a block
        k = number[i]
        v = entering[i] @ matrices[k]
        s = v.sum()
        entering[i + 1], before[i + 1] = v / s, before[i] + logs[k] + np.log(s)
    return entering, before, inner, matrices, (number if len(inner) else None)


def sequence_log_likelihood(symbols, starts, model, start, block=BLOCK) -> np.ndarray:
    """Natural log probability of every document's sequence."""
    blocks = Blocks(symbols, starts, block)
    entering, before, *_ = entering_vectors(blocks, model, start)
    out = np.zeros(len(starts) - 1)
    part, rows = blocks.only(np.flatnonzero(blocks.is_last))
    which = blocks.order[rows]
    _, scale, _ = forward(part, model, entering[which])
    out[blocks.doc[which]] = before[which] + scale
    return out


def expected_counts(symbols, starts, model, start, size: int, block=BLOCK):
    """Baum-Welch counts of these documents: start, transition, emission (size x states), log likelihood."""
    transition, emission = model
    states = len(start)
    blocks = Blocks(symbols, starts, block)
    entering, before, inner, matrices, number = entering_vectors(blocks, model, start)
    order = blocks.order
    alpha0 = entering[order]
    _, scale, kept = forward(blocks, model, alpha0, keep=True)
    back_after = np.ones((len(blocks.doc), states))  # in document order
    # Last blocks first: their backward vector before the block, by one backward sweep.
    need = np.flatnonzero(blocks.is_last & ~blocks.is_first)
    if len(need):
        part, rows = blocks.only(need)
        beta = np.ones((len(rows), states))
        for t in range(part.steps - 1, -1, -1):
            n = part.active[t]
            b = emission[symbols[part.begin[:n] + t]]
            beta[:n] = (beta[:n] * b) @ transition.T
            if t % RESCALE == 0:
                beta[:n] /= beta[:n].sum(axis=1, keepdims=True)
        before_last = np.zeros((len(order), states))
        before_last[order[rows]] = beta
        for i in inner[::-1].tolist():
            v = before_last[i + 1] if blocks.is_last[i + 1] else matrices[number[i + 1]] @ back_after[i + 1]
            back_after[i] = v / v.sum()
    beta = back_after[order]
    emitted = np.zeros((size, states))
    moved = np.zeros((states, states))
    first_row = blocks.is_first[order]
    started = np.zeros(states)
    flat_symbols, flat_gamma = [], []
    for t in range(blocks.steps - 1, -1, -1):
        n = blocks.active[t]
        alpha, total = kept[t]
        gamma = alpha * beta[:n]
        mass = gamma.sum(axis=1)
        gamma /= mass[:, None]
        at = symbols[blocks.begin[:n] + t]
        flat_symbols.append(at)
        flat_gamma.append(gamma)
        previous = kept[t - 1][0][:n] if t else alpha0[:n]
        weighted = beta[:n] * emission[at]
        moved += (previous / (mass * total)[:, None]).T @ weighted  # mass * total: the step's joint probability, unscaled
        if t == 0:
            joint = previous * (weighted @ transition.T)
            joint /= joint.sum(axis=1, keepdims=True)
            started += joint[first_row[:n]].sum(axis=0)
        beta[:n] = weighted @ transition.T
        if t % RESCALE == 0:  # counts don't depend on the scale of beta
            beta[:n] /= beta[:n].sum(axis=1, keepdims=True)
    if flat_symbols:
        all_symbols, all_gamma = np.concatenate(flat_symbols), np.concatenate(flat_gamma)
        for k in range(states):
            emitted[:, k] = np.bincount(all_symbols, weights=all_gamma[:, k], minlength=size)
    moved *= transition
    last = blocks.is_last[order]
    return started, moved, emitted, float(before[order][last].sum() + scale[last].sum())


def initial_model(unigram: np.ndarray, states: int, seed: int):
    """Sticky transitions and emissions around the symbol frequencies; deterministic."""
    rng = np.random.default_rng(seed)
    emission = unigram[:, None] * np.exp(rng.normal(0, 0.7, (len(unigram), states)))
    transition = np.full((states, states), 0.2 / max(1, states - 1))
    np.fill_diagonal(transition, 0.8 if states > 1 else 1.0)
    return np.full(states, 1 / states), (transition, emission / emission.sum(axis=0))


def renewed(started, moved, emitted, unigram, smoothing=SMOOTHING):
    """The model that the counts make likeliest, smoothed towards the symbol frequencies."""
    start = (started + 1.0) / (started + 1.0).sum()
    transition = (moved + 1.0) / (moved + 1.0).sum(axis=1, keepdims=True)
    emission = emitted + smoothing * unigram[:, None]
    return start, (transition, emission / emission.sum(axis=0))


def encode_rows(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Kind 0: id, tokens, known, base sum and the words' part of the model's score, from the bounded tables. Kind 1: a rare word of a row. Kind 2: symbols of consecutive rows, with their lengths and which are held out."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    id_type = rows.schema["id"].dataType.simpleString()
    symbol_type = "<u2" if lexicon.size <= 1 << 16 else "<u4"

    def run(batches):
        lex = shared.value
        row = TaskContext.get().partitionId() << 40
        log_total = np.log(lex.class_total)
        for batch in batches:
            ids, held = batch.column(1), np.asarray(batch.column(2).to_pylist(), dtype=bool)
            for first, hashes, at in batch_words(batch.column(0)):
                docs = len(at) - 1
                symbols, starts, counts, plain = lex.sequences(hashes, at)
                doc = np.repeat(np.arange(docs), np.diff(at))
                in_class = plain >= lex.own
                known = counts >= 0
                logs = np.where(known, np.log(np.maximum(counts, 0) + 1.0), 0.0)
                words = np.bincount(doc[in_class], weights=logs[in_class] - log_total[plain[in_class] - lex.own], minlength=docs)
                sums = np.bincount(doc, weights=logs, minlength=docs) + np.log(lex.end_count + 1.0)
                n_known = np.bincount(doc[known], minlength=docs) + (lex.end_count > 0)
                rare = np.flatnonzero(~known)
                key = np.stack([doc[rare], hashes[rare].view(np.int64)], axis=1) if len(rare) else np.zeros((0, 2), np.int64)
                order = np.lexsort((key[:, 1], key[:, 0]))
                key = key[order]
                new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) if len(key) else np.zeros(0, np.int64)
                n = np.diff(np.append(new, len(key)))
                rows_of, some = row + np.arange(docs), held[first : first + docs]
                kinds = np.repeat(np.asarray([0, 1, 2], np.int32), (docs, len(new), 1))

                def laid(values, where, kind):
                    out = np.zeros(len(kinds), dtype=kind)
                    out[where] = values
                    return pa.array(out)

                alone, rares = slice(0, docs), slice(docs, docs + len(new))
                none = [None] * (len(kinds) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kinds),
                        ids.take(pa.array(np.where(kinds == 0, first + np.arange(len(kinds)), 0), mask=kinds != 0)),
                        laid(some, alone, bool),
                        pa.array(np.concatenate([rows_of, rows_of[key[new, 0]], rows_of[:1]])),
                        laid(np.diff(at) + 1, alone, np.int64),
                        laid(n_known, alone, np.int64),
                        laid(sums, alone, np.float64),
                        laid(words, alone, np.float64),
                        laid(key[new, 1], rares, np.int64),
                        laid(n, rares, np.int64),
                        *(pa.array([*none, x], pa.binary()) for x in (np.packbits(some).tobytes(), np.diff(starts).astype("<u4").tobytes(), symbols.astype(symbol_type).tobytes())),
                    ],
                    names=["kind", "id", "held_out", "row", "n_tokens", "n_known", "sum_log", "words", "h", "n", "held", "lengths", "symbols"],
                )
                row += docs

    schema = f"kind int, id {id_type}, held_out boolean, row long, n_tokens long, n_known long, sum_log double, words double, h long, n long, held binary, lengths binary, symbols binary"
    return rows.select("text", "id", "held_out").mapInArrow(run, schema)


def packed_sequences(batch: pa.RecordBatch, size: int):
    """(first row, whether each is held out, symbols, starts) of the rows of kind 2: row, held, lengths, symbols."""
    symbol_type = "<u2" if size <= 1 << 16 else "<u4"
    for at in range(batch.num_rows):
        row, held, lengths, symbols = (c[at].as_py() for c in batch.columns)
        lengths = np.frombuffer(lengths, "<u4").astype(np.int64)
        held = np.unpackbits(np.frombuffer(held, np.uint8), count=len(lengths)).astype(bool)
        yield row, held, np.frombuffer(symbols, symbol_type).astype(np.int64), np.concatenate([[0], np.cumsum(lengths)])


def train_round(sequences: DataFrame, size: int, start, model) -> DataFrame:
    """k (symbol; below 0: -1 start, -2-i transition from i, -100 log likelihood) and expected counts e0.."""
    states = len(start)
    shared = sequences.sparkSession.sparkContext.broadcast((start, model))
    names = [f"e{i}" for i in range(states)]

    def run(batches):
        first_states, parameters = shared.value
        emitted, moved, started, fit, any_text = np.zeros((size, states)), np.zeros((states, states)), np.zeros(states), 0.0, False
        for batch in batches:
            for _, held, symbols, starts in packed_sequences(batch, size):
                if held.all():
                    continue
                lengths = np.diff(starts)
                mine, places = symbols[np.repeat(~held, lengths)], np.concatenate([[0], np.cumsum(lengths[~held])])
                s, m, e, f = expected_counts(mine, places, parameters, first_states, size)
                started, moved, fit, any_text = started + s, moved + m, fit + f, True
                emitted += e
        if any_text:
            keys = np.flatnonzero(emitted.any(axis=1))
            k = np.concatenate([keys, [-1], -2 - np.arange(states), [-100]])
            values = np.concatenate([emitted[keys], started[None], moved, np.full((1, states), fit)])
            yield pa.RecordBatch.from_arrays([pa.array(k), *(pa.array(values[:, i]) for i in range(states))], names=["k", *names])

    counts = sequences.mapInArrow(run, "k long, " + ", ".join(f"{n} double" for n in names))
    return counts.groupBy("k").agg(*(F.sum(n).alias(n) for n in names))


def sequence_scores(sequences: DataFrame, size: int, start, model) -> DataFrame:
    """row, seq: log probability of every row's symbols."""
    shared = sequences.sparkSession.sparkContext.broadcast((start, model))

    def run(batches):
        first_states, parameters = shared.value
        for batch in batches:
            for row, _, symbols, starts in packed_sequences(batch, size):
                seq = sequence_log_likelihood(symbols, starts, parameters, first_states)
                yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(len(seq))), pa.array(seq)], names=["row", "seq"])

    return sequences.mapInArrow(run, "row long, seq double")


def language_model_scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, own: int = OWN, classes: int = CLASSES, frequent: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row (log10)."""
    spark = docs.sparkSession
    rows = narrow(docs, id_col, text_col).toDF("id", "text").withColumn("held_out", held_out_column())
    counts, counts_path = store(word_counts(rows))
    total = counts.agg(F.count(F.lit(1)), F.sum("c")).first()
    ends = rows.where("NOT held_out").count()
    train_tokens, distinct = (total[1] or 0) + ends, total[0] + (ends > 0)
    top = counts.orderBy(F.desc("c"), "h").limit(frequent).toArrow()
    hashes, c = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy()
    rank = np.lexsort((hashes.view(np.int64), -c))
    hashes, c = hashes[rank], c[rank]

    lexicon = Lexicon(hashes, c, own, classes, np.ones(classes), ends, train_tokens, distinct)
    # Totals of the classes over all training words without a symbol: summed in Spark, `classes` rows back.
    own_count = lexicon.own
    border = (int(c[own_count - 1]), int(hashes.view(np.int64)[own_count - 1])) if own_count else None
    outside = counts if border is None else counts.where((F.col("c") < border[0]) | ((F.col("c") == border[0]) & (F.col("h") > border[1])))

    def classed(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((mix(h) >> np.uint64(40)).astype(np.int64) % classes), batch.column(1)], names=["k", "c"])

    per_class = outside.mapInArrow(classed, "k long, c long").groupBy("k").agg(F.sum(F.col("c") + 1).alias("t"), F.sum("c").alias("c")).toArrow()
    class_count = np.zeros(classes)
    k = per_class.column("k").to_numpy()
    class_count[k] = per_class.column("c").to_numpy()
    lexicon.class_total[k] += per_class.column("t").to_numpy()
    unigram = np.concatenate([c[:own_count] + 0.5, class_count + 0.5, [ends + 0.5]])
    unigram = unigram / unigram.sum()

    encoded, encoded_path = store(encode_rows(rows, lexicon))
    sequences = encoded.where("kind = 2").select("row", "held", "lengths", "symbols")
    start, model = initial_model(unigram, states, SEED)
    for _ in range(rounds if ends else 0):
        table = train_round(sequences, lexicon.size, start, model).toArrow()  # a row a symbol
        key = table.column("k").to_numpy()
        values = np.stack([table.column(f"e{i}").to_numpy() for i in range(states)], axis=1)
        emitted, moved = np.zeros((lexicon.size, states)), np.zeros((states, states))
        emitted[key[key >= 0]] = values[key >= 0]
        started = values[key == -1][0]
        for i in range(states):
            moved[i] = values[key == -2 - i][0]
        start, model = renewed(started, moved, emitted, unigram)

    rare = encoded.where("kind = 1").select("row", "h", "n")
    found = rare.join(counts.select("h", "c"), "h").select("row", (F.col("n") * F.log(F.col("c") + 1.0)).alias("more"), F.col("n").alias("more_known"), F.lit(0.0).alias("seq"))
    scored = sequence_scores(sequences, lexicon.size, start, model).select("row", F.lit(0.0), F.lit(0).cast("long"), "seq")
    added = found.union(scored).groupBy("row").agg(*(F.sum(n).alias(n) for n in ("more", "more_known", "seq")))
    ln10 = float(np.log(10.0))
    base_total = float(np.log(train_tokens + distinct + 1))
    out = encoded.where("kind = 0").select("id", "held_out", "row", "n_tokens", "n_known", "sum_log", "words").join(added, "row").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("more_known")).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        ((F.col("sum_log") + F.col("more") - F.col("n_tokens") * base_total) / ln10).alias("base_score"),
        ((F.col("seq") + F.col("words") + F.col("more")) / ln10).alias("score"),
    )
    out = cut(out)
    drop(spark, counts_path)
    drop(spark, encoded_path)
    return out


def op2_hidden_markov(spark, sf_dir):
    return language_model_scores(documents(spark, sf_dir))
