"""License scan: Aho-Corasick over words, and licence expressions by a shunting-yard parser.

Texts are lower-cased (A-Z) and reduced to their words (ASCII letters and digits, and every
non-ASCII character) with one blank between them, so a phrase is found where its words stand
consecutively, whatever stands between them. One automaton finds the notice phrases and the tags
that announce a licence expression. Behind a tag that stands on one line the expression is read up
to the line's end or the next tag: identifiers, `and`, `or`, `with` and parentheses, turned into
postfix order by the shunting-yard method (`with` binds tighter than `and`, `and` tighter than `or`)
and evaluated on the postfix stack: it is permissive if a choice among its alternatives needs
permissive licences only. An expression that doesn't parse (`and mit`, `(mit or x`) yields the
identifiers that it names and counts as not permissive. An expression's identifiers become labels.
A tag whose words stand on several lines announces nothing.

Score: the share of the found phrases and expressions that name a permissive licence, weighted by
how specific they are, or 0 if nothing is found.

Null and empty texts: no words, no labels, score 0. Repeated rows come back as often as they came.
Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import LOWER, documents, narrow

# Base phrases and labels of the query's contract.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notice phrases that the method adds.
NOTICE_PHRASES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "isc license": "isc",
    "boost software license": "bsl-1.0",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

# Words that announce a licence expression on their line.
TAGS = ("spdx license identifier", "license expression")

# Label prefixes that count as permissive.
PERMISSIVE = ("mit", "apache", "bsd", "isc", "bsl", "cc0", "cc-by", "public-domain", "zlib", "unlicense")

_TABLE = np.full(256, 0x20, dtype=np.uint8)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _TABLE[_lo : _hi + 1] = LOWER[_lo : _hi + 1]
WORD_TABLE = _TABLE.tobytes()

_TOKEN = re.compile(r"\s*(\(|\)|[a-z0-9.+\-]+)")
_TAG = r"(?:spdx[^a-z0-9\n]+license[^a-z0-9\n]+identifier|license[^a-z0-9\n]+expression)"
_TAG_LINE = re.compile(_TAG + r"[^a-z0-9\n(]*((?:(?!" + _TAG + r")[^\n])*)")
_BINDING = {"or": 1, "and": 2, "with": 3}


def to_postfix(text: str) -> list[str] | None:
    """Tokens in postfix order of the longest well-formed expression at the start of text, or None."""
    output: list[str] = []
    operators: list[str] = []
    at, want_operand, best = 0, True, None
    while m := _TOKEN.match(text, at):
        token = m[1]
        if token == "(":
            if not want_operand:
                break
            operators.append(token)
        elif token == ")":
            if want_operand or "(" not in operators:
                break
            while operators[-1] != "(":
                output.append(operators.pop())
            operators.pop()
        elif token in _BINDING:
            if want_operand:
                break
            while operators and operators[-1] != "(" and _BINDING[operators[-1]] >= _BINDING[token]:
                output.append(operators.pop())
            operators.append(token)
            want_operand = True
        else:
            if not want_operand:
                break
            output.append(token)
            want_operand = False
        at = m.end()
        if not want_operand and "(" not in operators:
            best = [*output, *reversed(operators)]
    return best


def permissive(postfix: list[str]) -> bool:
    """Whether some choice among the alternatives needs permissive licences only; an exception leaves its licence as it is."""
    stack: list[bool] = []
    for token in postfix:
        if token not in _BINDING:
            stack.append(token.startswith(PERMISSIVE))
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left or right if token == "or" else left and right if token == "and" else left)
    return stack[0]


def named_first(text: str) -> list[str]:
    """The identifiers at the start of a text, as far as operators and parentheses hold them together."""
    out, at, joined = [], 0, True
    while m := _TOKEN.match(text, at):
        if m[1] in _BINDING:
            joined = True
        elif m[1] not in "()":
            if not joined:
                break
            out.append(m[1])
            joined = False
        at = m.end()
    return out


def expression_labels(text: str) -> tuple[set[str], bool]:
    """Identifiers named by the expression, and whether a permissive choice satisfies it."""
    postfix = to_postfix(text)
    if not postfix:
        return set(named_first(text)), False
    return {t for t in postfix if t not in _BINDING}, permissive(postfix)


def build_automaton():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("notice", NOTICE_PHRASES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            machine.add_word(f" {phrase} ", (kind, label, len(phrase) + 1, len(phrase.split())))
    machine.make_automaton()
    return machine


def scan_text(machine, text: str):
    """n_words, n_base, first and last word of base places, base labels, all labels, score."""
    words = text.encode().translate(WORD_TABLE).split()
    line = f" {b' '.join(words).decode()} "
    starts, base, labels, weight, good, tagged = [], set(), set(), 0, 0, False
    for end, (kind, label, length, size) in machine.iter(line):
        if kind == "tag":
            tagged = True
            continue
        labels.add(label)
        weight += size
        good += size * label.startswith(PERMISSIVE)
        if kind == "base":
            starts.append(end - length)
            base.add(label)
    if tagged:
        for m in _TAG_LINE.finditer(text.lower()):
            named, choice = expression_labels(m[1])
            labels |= named
            weight += 4 * bool(named)
            good += 4 * choice
    first = line.count(" ", 0, min(starts)) if starts else None
    last = line.count(" ", 0, max(starts)) if starts else None
    return len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), good / weight if weight else 0.0


OUTPUT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = narrow(docs, id_col, text_col).toDF("id", "text")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
    names = [x.split()[0] for x in OUTPUT.split(", ")]

    def run(batches):
        machine = build_automaton()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out = [scan_text(machine, t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, t in zip(zip(*out), types))], names=["id", *names])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {OUTPUT}").withColumnRenamed("id", id_col)


def op5_license_scan(spark, sf_dir):
    return scan(documents(spark, sf_dir)).select("doc_id", *(F.col(x.split()[0]) for x in OUTPUT.split(", ")))
