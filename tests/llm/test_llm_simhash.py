import random
import re

import numpy as np
import pytest
import xxhash

from llm_helpers import awkward, docs, empty
from polikit.llm import simhash as S


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, bits):
    """Groups of distinct fingerprints, by comparing all pairs."""
    u = np.array(sorted(set(fps)), dtype=np.uint64)
    parent = list(range(len(u)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= bits):
            parent[find(i)] = find(int(j))
    return {int(v): find(i) for i, v in enumerate(u)}


def expected(rows):
    fps = [slow_fingerprint(r[1]) for r in rows]
    group = components(fps, 2)
    least = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            least[group[f]] = min(least.get(group[f], r[0]), r[0])
    return sorted(((r[0], f"{f:016x}", least.get(group[f])) for r, f in zip(rows, fps)), key=str)


@pytest.mark.parametrize("clashes", [False, True])
def test_awkward_rows_against_brute_force(spark, clashes):
    got = S.simhash_dedup(docs(spark, clashes=clashes)).collect()
    assert sorted(map(tuple, got), key=str) == expected(awkward())


def test_empty_table(spark):
    assert S.simhash_dedup(empty(spark)).collect() == []
    assert S.keep_one(empty(spark)).collect() == []


@pytest.mark.parametrize("bits,cap", [(1, 64), (2, 64), (2, 3)])
def test_links_connect_what_brute_force_connects(spark, bits, cap):
    """A large ball of near fingerprints (hot buckets) among others, also beyond the cap."""
    rng = random.Random(bits * 100 + cap)
    centre, fps = rng.getrandbits(64), {rng.getrandbits(64) for _ in range(60)}
    for base, n, most in [(centre, 600, 5), *((b, 6, 4) for b in list(fps))]:
        for _ in range(n):
            x = base
            for _ in range(rng.randint(0, most)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {}
    for r in S.roots(S.links(df, bits, cap)).collect():
        got.setdefault(r["root"], set()).add(r["node"])
    want = {}
    for f, g in components(fps, bits).items():
        want.setdefault(g, set()).add(int(np.uint64(f).astype(np.int64)))
    assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values() if len(v) > 1}


def test_no_bits_links_only_equal_fingerprints(spark):
    rows = [(1, "a b c d", "en", "s", 1), (2, "a b c d", "en", "s", 1), (3, "x y z", "en", "s", 1)]
    got = {r["doc_id"]: r["component_id"] for r in S.simhash_dedup(docs(spark, rows), max_bits=0).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_long_chain_is_one_component(spark):
    chain = [(1 << i) - 1 for i in range(64)]
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in chain], "fp long")
    assert S.roots(S.links(df, 1)).select("root").distinct().count() == 1


def test_keep_one(spark):
    rows = awkward()
    kept = S.keep_one(docs(spark, clashes=True))
    assert kept.columns == docs(spark, clashes=True).columns
    want = sorted({c for i, _, c in expected(rows) if i is not None})
    got = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert got == want
    assert sum(r["doc_id"] is None for r in kept.collect()) == sum(r[0] is None for r in rows)


def test_keep_one_of_each_group_where_ids_repeat(spark):
    a, b, c = "a b c d e f g", "one two three four five", "uno dos tres cuatro cinco"
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (5, b, "en", "s", 1), (7, a, "en", "s", 1), (7, c, "en", "s", 1),
            (3, c, "en", "s", 1)]
    kept = S.keep_one(docs(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(3, c), (5, a), (5, b)]


def test_ids_with_names_of_the_operators_own_columns(spark):
    for name in ("id", "fp", "row_id", "text_", "root", "node"):
        df = spark.createDataFrame([(5, "a b c d e f"), (6, "a b c d e f"), (7, "x y z u v w")], f"{name} long, text string")
        got = {r[name]: r["component_id"] for r in S.simhash_dedup(df, id_col=name).collect()}
        assert got == {5: 5, 6: 5, 7: 7}
    with pytest.raises(ValueError, match="fingerprint"):
        S.simhash_dedup(spark.createDataFrame([(5, "a")], "fingerprint long, text string"), id_col="fingerprint")
