"""SentencePiece encoding and decoding as weighted finite-state transduction.

A model file is compiled to three machines. The normaliser rewrites characters: blanks become the
blank mark, and as the model has it a mark goes in front and runs of blanks shrink (a model with a
table of character rewritings brings its own compiled normaliser, which is used as it is). The piece
machine is a trie with a final state per piece. Byte fallback has an arc per character without a
piece. The machines are composed with an input lazily: `arcs_from` gives the arcs that leave a
place of the normalised input, `weight` an arc's weight behind the piece before it, and a path's
weight is the sum of its arcs', so the best path is the shortest in the tropical semiring.

In a unigram model a piece weighs minus its score and an unknown character 10 more than the heaviest
piece; `lightest_path` relaxes the arcs place by place. In a byte-pair model the piece machine is a
bigram machine: its states are the last piece read, and an arc u -> v weighs 0 where merging the
characters of u + v by rank gives just [u, v], and infinity elsewhere. A sequence of pieces is what
the merge procedure makes of a string if and only if every two neighbours are such a pair, so the
composition has one path of finite weight, and that is the shortest. `lightest_path` finds it by
relaxing all arcs between (place, piece) states, `zero_path`, which the encoder takes, by following
arcs of weight 0 depth first: with no weights but 0 and infinity, the first path that arrives is
shortest. The tests hold the two against each other, and both kinds of model against the library.
Weights of arcs are kept in a bounded table.

No piece holds a blank mark behind another character, so the composition falls apart in front of
each run of marks; these parts are solved once and kept in a bounded table. Inputs of a model whose
pieces break that rule are solved in one part. Neighbouring unknown characters of a model without
byte fallback are one unknown piece, as in the library.

Decoding concatenates pieces and bytes, turns marks into blanks and drops the first. It gives the
text back exactly unless the text holds the mark itself.

Null and empty texts: no pieces. Repeated rows come back as often as they came. Empty table: no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import documents, narrow

MARK = "▁"
PART_TABLE = 400_000
ARC_TABLE = 600_000
LONGEST_KEPT = 48
ARC_STRIDE = 1 << 24

_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceTransducer:
    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        # What a piece decodes to: control pieces to nothing, the unknown one to the library's sign.
        self.surfaces = ["" if model.is_control(i) else " ⁇ " if model.is_unknown(i) else p for i, p in enumerate(self.pieces)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {i: model.get_score(i) for i in plain}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.is_byte = np.zeros(size, dtype=np.int64)
        self.is_byte[list(self.byte_of)] = 1
        self.unknown = model.unk_id()
        # The piece machine as a trie: every prefix of a piece, with the piece's id or -1.
        self.prefixes = {p[:k]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        # The normaliser's settings, read off what it does.
        self.prefix = model.normalize(f"a{MARK}")[:1] == MARK
        self.shrinks = model.normalize(" a  b ").strip(MARK) == f"a{MARK}b" and not model.normalize("b ").endswith(MARK)
        probe = "ﬁ½Å\u3000Ⅳ\tx\u200b"
        self.own_normaliser = None if model.normalize(probe).lstrip(MARK) == probe else model
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.ids)
        # Fixed by the format: byte-pair models number their merges, so scores fall by whole steps.
        self.merging = all(float(s).is_integer() for s in self.scores.values())
        self.unknown_weight = 10.0 - min(self.scores.values(), default=0.0)
        self.parts: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}  # the table before the last change of tables
        self.arcs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces after merging the characters of a short string by rank, leftmost first."""
        symbols = list(text)
        ids, scores = self.ids, self.scores
        ranks = [scores.get(ids.get(a + b), -math.inf) for a, b in zip(symbols, symbols[1:])]
        while ranks:
            best = max(ranks)
            if best == -math.inf:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = scores.get(ids.get(symbols[at] + symbols[at + 1]), -math.inf)
            if at:
                ranks[at - 1] = scores.get(ids.get(symbols[at - 1] + symbols[at]), -math.inf)
        return symbols

    def passes(self, left: int, right: int) -> bool:
        """Whether the arc from piece left (-1: none) to piece right has a finite weight."""
        key = left * ARC_STRIDE + right
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= ARC_TABLE:
                self.arcs.clear()
            v = self.pieces[right]
            known = self.merged(v) == [v] if left < 0 else self.merged(self.pieces[left] + v) == [self.pieces[left], v]
            self.arcs[key] = known
        return known

    def solve(self, part: str) -> tuple[int, ...]:
        """Ids on the shortest path over a normalised part."""
        path = self.zero_path(part) if self.merging else self.lightest_path(part)
        ids = [k for k, _ in path]
        if min(ids, default=0) >= 0:
            return tuple(ids)
        out, at = [], 0
        for k, end in path:
            if k >= 0:
                out.append(k)
            elif self.bytes:
                out.extend(self.bytes[b] for b in part[at:end].encode())
            elif out[-1:] != [self.unknown]:
                out.append(self.unknown)
            at = end
        return tuple(out)

    def arcs_from(self, part: str, begin: int) -> list[tuple[int, int]]:
        """Pieces (-1: the character in bytes) that begin here, with their ends, shortest first."""
        get, found = self.prefixes.get, []
        for end in range(begin + 1, len(part) + 1):
            k = get(part[begin:end])
            if k is None:
                break
            if k >= 0:
                found.append((k, end))
        return found if found and found[0][1] == begin + 1 else [(-1, begin + 1), *found]

    def zero_path(self, part: str) -> list[tuple[int, int]]:
        """Shortest path where arcs weigh 0 or infinity: depth first, longest piece first.

        A place is reached by one path at most (that of its prefix), so one that fails once is dead."""
        n, known_arc, leaving = len(part), self.arcs.get, self.arcs_from
        pieces, ends, dead = [], [], set()
        at, before, levels = 0, -1, [leaving(part, 0)]
        while at < n:
            choices, base = levels[-1], before * ARC_STRIDE
            while choices:
                k, end = choices.pop()
                if end in dead:
                    continue
                if k < 0:  # no merge reaches over a character in bytes
                    break
                known = known_arc(base + k)
                if self.passes(before, k) if known is None else known:
                    break
            else:
                dead.add(at)
                levels.pop()
                pieces.pop()
                ends.pop()
                at, before = (ends[-1], pieces[-1]) if ends else (0, -1)
                continue
            pieces.append(k)
            ends.append(end)
            at, before = end, k
            if end < n:
                levels.append(leaving(part, end))
        return list(zip(pieces, ends))

    def weight(self, left: int, right: int) -> float:
        """Weight of the arc that reads piece right (-1: a character without a piece) behind piece left (-1: none)."""
        if not self.merging:
            return -self.scores[right] if right >= 0 else self.unknown_weight
        return 0.0 if right < 0 or self.passes(left, right) else math.inf

    def lightest_path(self, part: str) -> list[tuple[int, int]]:
        """Shortest path by relaxing all arcs in order of places; a state is a place, with the last piece where weights ask for it."""
        n = len(part)
        # Of each place: state -> weight so far, piece read, where it began, state before.
        reached: list[dict[int, tuple[float, int, int, int]]] = [{} for _ in range(n + 1)]
        reached[0][-1] = (0.0, -1, 0, -1)
        for begin in range(n):
            arcs = self.arcs_from(part, begin) if reached[begin] else ()
            for state, (so_far, *_) in reached[begin].items():
                for k, end in arcs:
                    w, after = so_far + self.weight(state, k), k if self.merging else -1
                    if w < reached[end].get(after, (math.inf,))[0]:
                        reached[end][after] = (w, k, begin, state)
        path, at, state = [], n, min(reached[n], key=lambda k: reached[n][k][0], default=-1)
        while at:
            _, k, begin, before = reached[at][state]
            path.append((k, at))
            at, state = begin, before
        return path[::-1]

    def normalise(self, text: str) -> str:
        if self.own_normaliser is not None:
            return self.own_normaliser.normalize(text)
        if self.shrinks:
            text = " ".join(x for x in text.split(" ") if x)
        return (MARK if self.prefix else "") + text.replace(" ", MARK) if text else ""

    def encode(self, text: str) -> list[int]:
        line = self.normalise(text)
        table, out = self.parts, []
        for part in _PARTS.findall(line) if self.splits else [line] if line else []:
            ids = table.get(part)
            if ids is None:
                ids = self.older.get(part) or self.solve(part)
                if len(part) <= LONGEST_KEPT:
                    if len(table) >= PART_TABLE:
                        self.older, self.parts = table, {}
                        table = self.parts
                    table[part] = ids
            out += ids
        if not self.bytes:  # unknown characters on both sides of a part's end are one piece
            out = [k for i, k in enumerate(out) if k != self.unknown or not i or out[i - 1] != k]
        return out

    def decode(self, ids: list[int]) -> str:
        if self.byte_of.keys().isdisjoint(ids):
            out = map(self.surfaces.__getitem__, ids)
        else:
            out, raw = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    out.append(raw.decode(errors="replace"))
                    raw = bytearray()
                out.append(self.surfaces[i])
            out.append(raw.decode(errors="replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@functools.lru_cache(maxsize=1)
def transducer_of(model_file: str) -> PieceTransducer:
    """One compiled model a Python worker, with its tables, kept over its tasks."""
    return PieceTransducer(model_file)


def encode_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids, n_pieces, n_fallback (byte pieces), decoded_sha256, exact (whether decoding gives the text back)."""
    rows = narrow(docs, id_col, text_col).toDF("id", "text")

    def run(batches):
        machine = transducer_of(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                out = [], [], [], []
                for text in part.column(1).to_pylist():
                    ids = machine.encode(text or "")
                    back = machine.decode(ids)
                    for column, value in zip(out, (np.asarray(ids, dtype=np.int32), len(ids), hashlib.sha256(back.encode()).hexdigest(), back == (text or ""))):
                        column.append(value)
                ends = np.concatenate([[0], np.cumsum(out[1])]).astype(np.int32)
                flat = np.concatenate([*out[0], np.zeros(0, np.int32)])
                fallback = np.concatenate([[0], np.cumsum(machine.is_byte[flat])])[ends]
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(out[1], pa.int64()), pa.array(np.diff(fallback).astype(np.int64)), pa.array(out[2], pa.string()), pa.array(out[3], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "n_pieces", "n_fallback", "decoded_sha256", "exact"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, ids array<int>, n_pieces long, n_fallback long, decoded_sha256 string, exact boolean").withColumnRenamed("id", id_col)


def decode_ids(rows: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and decoded text of arrays of ids."""
    rows = narrow(rows, id_col, ids_col).toDF("id", "ids")

    def run(batches):
        machine = transducer_of(model_file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([machine.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())], names=["id", "text"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_piece_transducer(spark, sf_dir):
    return encode_documents(documents(spark, sf_dir), default_model())
