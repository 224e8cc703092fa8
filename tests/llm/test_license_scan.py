import random
import re

import pytest

from tidemark.llm import license_scan as L


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in L.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    None, "", "MIT License", "mit\n  LICENSE, apache-license!", "the mit licensed mit license mit license", "smit license", "GNU Lesser General Public License and general public license",
    "ümit license É mit license", "a" * 100_000 + " MIT license", "all rights\treserved\x00mit\x7flicense", "mit mit license",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_matches_brute_force(text):
    assert L.scan_text(L.build_automaton(), text or "")[:5] == brute(text)


def test_expressions():
    assert L.to_postfix("mit or apache-2.0 and bsd-3-clause") == ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]
    assert L.to_postfix("(mit or x) and y */") == ["mit", "x", "or", "y", "and"]
    assert L.to_postfix("gpl-2.0 with classpath-exception or mit") == ["gpl-2.0", "classpath-exception", "with", "mit", "or"]
    assert L.to_postfix("and mit") is None
    assert L.permissive(["mit", "x", "or", "bsd", "and"]) and not L.permissive(["mit", "x", "and"]) and L.permissive(["apache-2.0", "x", "with"])
    assert L.expression_labels("gpl-3.0 or mit") == ({"gpl-3.0", "mit"}, True)
    assert L.expression_labels("gpl-3.0 and mit") == ({"gpl-3.0", "mit"}, False)


def brute_permissive(postfix):
    """All sets of licences that satisfy the expression, told apart without a bound."""
    stack = []
    for token in postfix:
        if token not in ("or", "and", "with"):
            stack.append({frozenset([token])})
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left | right if token == "or" else {a | b for a in left for b in right} if token == "and" else left)
    return any(all(x.startswith(L.PERMISSIVE) for x in choice) for choice in stack[0])


def test_permissive_matches_all_alternatives():
    rng = random.Random(3)

    def expression(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(["mit", "gpl-2.0", "bsd-3-clause", "x with y", "isc"])
        return f"({expression(depth - 1)} {rng.choice(['and', 'or'])} {expression(depth - 1)})"

    for _ in range(300):
        text = expression(4)
        assert L.expression_labels(text)[1] == brute_permissive(L.to_postfix(text)), text
    many = [f"gpl-{i}" for i in range(70)]
    assert L.expression_labels(" or ".join([*many, "mit"])) == ({*many, "mit"}, True)
    assert L.expression_labels(" or ".join(["mit", *many])) == ({*many, "mit"}, True)


def test_expressions_that_do_not_parse_and_several_tags_on_a_line():
    assert L.expression_labels("(mit or apache-2.0") == ({"mit", "apache-2.0"}, False)
    assert L.expression_labels("and mit") == ({"mit"}, False)
    assert L.expression_labels("") == (set(), False)
    machine = L.build_automaton()
    two = "SPDX-License-Identifier: MIT SPDX-License-Identifier: GPL-2.0 OR BSD-3-Clause"
    assert L.scan_text(machine, two)[5:] == ("bsd-3-clause,gpl-2.0,mit", 1.0)
    assert L.scan_text(machine, "SPDX-License-\nIdentifier: MIT")[5:] == ("", 0.0)


def test_tags_and_rows(spark):
    rows = [(1, "// SPDX-License-Identifier: (GPL-2.0 OR MIT)\nx", 3), (1, None, 3), (2, "nothing", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = sorted((tuple(r) for r in L.scan(df).collect()), key=str)
    assert got == [(1, 0, 0, None, None, "", "", 0.0), (1, 9, 0, None, None, "", "gpl-2.0,mit", 1.0), (2, 1, 0, None, None, "", "", 0.0)]
    assert L.scan(df.limit(0)).count() == 0
