import math
import random
import re

import pytest

from llm_helpers import awkward, docs, empty
from polikit.llm import mixing as M


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_targets(sizes):
    """By the contract: shares by weight, cut at twice the size, the excess shared out again."""
    sources = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    target = {s: 0.0 for s in sources}
    left, open_ = 1.5 * sum(sizes.values()), set(sources)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def corpus(seed=1, n=1500):
    """One source with a third of all rows, sources of every size, heavy-tailed documents."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "d", None, "é", "Z"])
        k = min(3000, int(rng.paretovariate(1.1) * 5))
        rows.append((i, " ".join(f"w{rng.randint(0, 99)}" for _ in range(k)), "en", source, 1))
    return rows


def check(rows, got):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + n_words(r[1])
    target, most = slow_targets(sizes), {}
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r[0]), n_words(r[1])) for r in rows)
    by_target = {}
    source_of = {(r[0], n_words(r[1])): r[3] for r in rows}
    for r in got:
        s = source_of[(r["doc_id"], r["size"])]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], target[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by_target[s] = by_target.get(s, 0) + r["taken"]
        most[s] = max(most.get(s, 0), r["size"])
    return {s: (by_target[s], target[s], most[s]) for s in by_target}


def test_targets_and_words_taken(spark):
    rows = corpus()
    df = docs(spark, rows, clashes=True)
    got = M.mix_digest(df).collect()
    for taken, target, most in check(rows, got).values():
        assert abs(taken - target) <= max(20, 0.003 * target), (taken, target, most)
    again = M.mix_digest(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_tilts_take_their_targets(spark):
    """The dual's solution: the rates' expected words are the targets; rates grow with size or fall."""
    rows = corpus(4)
    places = docs(spark, rows).select("source", M.n_words(M.F.col("text")).alias("size"))
    state = M.tilts(places, M.targets(places)).collect()
    for r in state:
        own = [n_words(x[1]) for x in rows if x[3] == r["source"]]
        if r["theta"] is not None:
            words = sum(x * min(2.0, math.exp(r["theta"] * x)) for x in own)
            assert abs(words - r["target"]) <= 1e-4 * r["target"]
        else:
            assert math.isclose(r["target"], 2 * sum(own), rel_tol=1e-9)


def test_awkward_rows(spark):
    rows = awkward()
    got = M.mix_digest(docs(spark, rows, clashes=True)).collect()
    for taken, target, most in check(rows, got).values():
        assert abs(taken - target) <= 4 * most  # equal rows move together
    mixed = M.mixed(docs(spark, rows, clashes=True))
    assert mixed.columns == docs(spark, rows, clashes=True).columns
    total = sum(r["taken"] for r in got)
    assert sum(n_words(r["text"]) for r in mixed.collect()) == total


def test_mixed_repeats_what_the_digest_takes(spark):
    rows = corpus(7, 400)
    taken = {r["doc_id"]: r["taken"] for r in M.mix_digest(docs(spark, rows)).collect()}
    seen = {}
    for r in M.mixed(docs(spark, rows)).collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + n_words(r["text"])
    assert {i: seen.get(i, 0) for i in taken} == taken


def test_other_plan_gives_the_same(spark, monkeypatch):
    from polikit.llm import common
    df = docs(spark, corpus(9, 300))
    one = sorted(map(str, M.mix_digest(df).collect()))
    monkeypatch.setattr(M, "broadcast_if_small", lambda x, rows=None, limit=0: common.broadcast_if_small(x, rows, 0))
    assert sorted(map(str, M.mix_digest(df).collect())) == one


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "a b c", "en", "s", 5)],
                                  [(1, "a", "en", "s", 1), (2, "", "en", "t", 0)]])
def test_tiny_tables(spark, rows):
    df = docs(spark, rows) if rows else empty(spark)
    got = M.mix_digest(df).collect()
    assert len(got) == len(rows)
    check(rows, got)
    assert M.mixed(df).columns == df.columns


@pytest.mark.parametrize("share", [1.5015, 1.4985, 1.511])
def test_the_last_document_is_taken_if_that_is_nearer(spark, share):
    rows = [(i, "w " * 100, "en", "a", 1) for i in range(111)]
    (taken, target, _), = check_share(rows, M.mix_digest(docs(spark, rows), share=share).collect())
    assert abs(taken - target) <= 50


def check_share(rows, got):
    assert len(got) == len(rows)
    return [(sum(r["taken"] for r in got), got[0]["target"], 100)]
