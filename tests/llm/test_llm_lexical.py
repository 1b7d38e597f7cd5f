"""Ranked search against the formula, one number at a time."""

import math
import random
import re
from collections import Counter

import pytest

from llm_helpers import awkward, docs, empty
from polikit.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string"


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plainly(rows, items, k=20):
    live = [(i, plain_terms(t)) for i, t in rows]
    live = [(i, w) for i, w in live if w]
    n_docs, n_terms = len(live), sum(len(w) for _, w in live)
    df = Counter(t for _, w in live for t in set(w))
    out = []
    for item, text in set(items):
        scored = []
        for i, w in live:
            tf, m = Counter(w), 100 - 25 + (25 * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t in plain_terms(text))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, df, items, **kw):
    return sorted((tuple(r) for r in S.search(df, spark.createDataFrame(items, ITEM), **kw).collect()), key=str)


def test_terms():
    for text in ("Ab-cd É ÀB 中文!x_y9", "", None, "\x00a\x7fb c", " \t"):
        assert [t.decode() for t in S.terms(None if text is None else text.encode())] == plain_terms(text)


def some_items(seed=4, n=30):
    rng = random.Random(seed)
    return [(i, " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 12))))
            for i in range(n)]


def some_rows(seed=5, n=300):
    rng = random.Random(seed)
    return [(i, " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("cells,index_bytes", [(1 << 20, 1 << 20), (40, 1 << 20), (1 << 20, 150)])
def test_against_the_formula(spark, monkeypatch, cells, index_bytes):
    """In one batch, in small batches, and with the items in many blocks."""
    monkeypatch.setattr(S, "CELLS", cells)
    rows, items = some_rows(), some_items(n=30 if index_bytes > 1000 else 12)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(spark, df, items, index_bytes=index_bytes) == plainly(rows, items)
    assert found(spark, df, items, k=3) == plainly(rows, items, 3)


def test_ties_go_by_id_across_tasks(spark):
    rows = [(i, "same words here") for i in range(90)] + [(500 + i, "other") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = found(spark, df, [(1, "words")])
    assert sorted(r[2] for r in got) == list(range(20)) and {r[1] for r in got} == set(range(1, 21))
    assert got == plainly(rows, [(1, "words")])


@pytest.mark.parametrize("clashes", [False, True])
def test_awkward_rows(spark, clashes):
    rows = [(r[0], r[1]) for r in awkward()]
    words = rows[0][1].split()
    items = [(1, " ".join(words[:3])), (1, " ".join(words[:3])), (2, None), (3, ""), (None, words[0]), (4, "nowhere-to-be-found"),
             (5, "ONE two TWO"), (6, "中文 ßü"), (7, awkward()[34][1] or "x"), (8, "x " * 3000)]
    want = plainly(rows, items)
    assert found(spark, docs(spark, clashes=clashes), items) == want
    assert {r[0] for r in want} >= {1, None, 5, 6}


def test_empty_tables(spark):
    assert found(spark, empty(spark), some_items()) == []
    assert found(spark, docs(spark), []) == []
    assert found(spark, docs(spark), [(1, None), (2, "-")]) == []
