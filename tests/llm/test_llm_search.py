import heapq
import random

import numpy as np
import pytest

from polikit.llm import vector_search as V

VEC = "vec_id long, embedding array<float>, label int"


def rows_of(n=700, seed=1, dims=8):
    """Clusters, one vector that a third of all rows share, and every unusable kind."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    hot = [float(np.float32(x)) for x in centres[0]]
    rows = []
    for i in range(n):
        v = hot if i % 3 == 0 else (centres[i % 6] + rng.normal(size=dims) * 0.3).astype(np.float32).tolist()
        rows.append((i, v, 1))
    rows += [(1000, None, 1), (1100, [0.0] * dims, 1), (1200, [1.0] * (dims - 1), 1), (1300, [None] + [1.0] * (dims - 1), 1),
             (1400, [float("nan")] + [1.0] * (dims - 1), 1), (1500, [float("inf")] * dims, 1), (1600, [], 1),
             (None, [1.0] * dims, 1), (1700, [1.0] * dims, None), (1701, [1.0] * dims, None), (1701, [1.0] * dims, None)]
    return rows


def exact(rows, every, k=10):
    dims = 8
    ok = [(i, np.array(v, dtype=np.float64)) for i, v, _ in rows if i is not None and v is not None and len(v) == dims
          and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        qv = next(v for i, v in ok if i == q)
        scored = []
        for i, v in ok:
            if i != q:
                s = 0.0
                for d in range(dims):
                    s += (qv[d] - v[d]) ** 2
                scored.append((float(np.sqrt(s)), i))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(heapq.nsmallest(k, scored))]
    return out


def test_all_cells_visited_is_exact(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, VEC).selectExpr("*", "1 AS v", "2 AS cell", "3 AS shard")
    got = V.search_every(df, 20, shard_rows=50).collect()
    assert sorted(map(tuple, got)) == sorted(exact(rows, 20))


def test_traversal_is_in_order_of_summed_distance():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = rng.random(5), rng.random(7)
        counts = rng.integers(0, 4, 35)
        cells = V.visit(a, b, counts, int(counts.sum()))
        sums = [a[c // 7] + b[c % 7] for c in cells]
        assert sums == sorted(sums) and set(cells) == set(np.flatnonzero(counts))
        some = V.visit(a, b, counts, 10)
        assert some == cells[:len(some)] and counts[some].sum() >= 10 > counts[some[:-1]].sum()


def test_recall(spark):
    """Vectors without structure, where half of the entries are visited."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VEC)
    got = V.search_every(df, 100, least=100).collect()
    y = x.astype(np.float64)
    hits = 0
    for q in range(0, 4000, 100):
        d = ((y - y[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10]) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits / (10 * 40) >= 0.9


def test_repeated_query_ids_ask_with_the_smallest_vector(spark):
    rows = [(0, [2.0, 2.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 1.1], 1), (2, [2.0, 2.1], 1)]
    got = V.search_every(spark.createDataFrame(rows, VEC), 100).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 2)]


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(0, [1.0, 2.0], 1)]])
def test_nothing_to_find(spark, rows):
    assert V.search_every(spark.createDataFrame(rows, VEC), 100).collect() == []


def placed(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def nearest(x, q, k=10):
    """By exact rational squares of the differences, which are those of doubles."""
    from fractions import Fraction
    gaps = sorted((sum(Fraction(float(a) - float(b)) ** 2 for a, b in zip(x[q], v)), i) for i, v in enumerate(x) if i != q)
    return [i for _, i in gaps[:k]]


@pytest.mark.parametrize("offset,size", [(1e8, 1.0), (0.0, 1e200), (1e200, 1e190), (0.0, 1e-200), (-3e15, 1.0)])
def test_offsets_and_magnitudes_lose_no_neighbour(spark, offset, size):
    x = offset + np.random.default_rng(7).normal(size=(400, 6)) * size
    got = V.search_every(placed(spark, x), 100).collect()
    for q in range(0, 400, 100):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [i for _, i, _ in own] == nearest(x, q)
        assert all(np.isfinite(s) and s > 0 for _, _, s in own)


def test_vectors_of_all_magnitudes_together(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 4)) * 10.0 ** rng.choice([-150, -3, 0, 8, 160, 300], size=300)[:, None]
    got = V.search_every(placed(spark, x), 50).collect()
    for q in range(0, 300, 50):
        assert {r["vec_id"] for r in got if r["query_id"] == q} == set(nearest(x, q))


@pytest.mark.parametrize("hot", [False, True])
def test_recall_of_the_index_itself(spark, hot):
    """More rows than are searched whole, 64 dimensions, with one vector that a third of all rows share."""
    n, rng = 12_000, np.random.default_rng(11)
    x = rng.normal(size=(n, 64)).astype(np.float32)
    if hot:
        x[1::3] = x[1]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").repartition(8)
    got = V.search_every(df, 200, least=1000).collect()
    y, found = x.astype(np.float64), {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, n, 200):
        d = ((y - y[q]) ** 2).sum(1)
        d[q] = np.inf
        kth = np.partition(d, 9)[9]
        hits += sum(d[i] <= kth for i in found[q])  # any of equal ones counts
    assert hits / (10 * len(found)) >= 0.9 and len(found) == n // 200


def heap_visit(a, b, counts, enough):
    """The cells by a heap of (sum, rank, rank), one at a time."""
    first, second = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    heap, held, out = [(a[first[0]] + b[second[0]], 0, 0)], 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(first[i] * len(b) + second[j])
        if counts[cell]:
            out.append(cell)
            held += counts[cell]
        if j + 1 < len(b):
            heapq.heappush(heap, (a[first[i]] + b[second[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[first[i + 1]] + b[second[0]], i + 1, 0))
    return out


def test_traversal_is_that_of_a_heap():
    rng = np.random.default_rng(4)
    for n in range(60):
        a, b = (rng.integers(0, 4, size).astype(float) if n % 2 else rng.random(size) for size in (6, 5))
        counts = rng.integers(0, 3, 30)
        for enough in (0, 1, 7, 30, 1000):
            assert V.visit(a, b, counts, enough) == heap_visit(a, b, counts, enough)


@pytest.mark.parametrize("offset,size", [(0.0, 1.0), (1e8, 1.0), (0.0, 1e-30), (0.0, 1e200)])
def test_few_pairs_are_measured(monkeypatch, offset, size):
    """Queries meet thousands of entries, a third of them one vector: a few hundredths of the pairs are measured, with the exact best."""
    rng, k, n = np.random.default_rng(12), 5, 6000
    x = offset + rng.normal(size=(n, 16)) * size
    x[::3] = x[0]
    ids, cell = rng.permutation(n), np.sort(rng.integers(0, 16, n)).astype(np.int32)
    ids[1::200] = ids[0]  # ids that repeat
    q_ids, q = ids[:300:3][:90].copy(), x[:270:3] + 0.0
    q[::2] = x[1:270:6]
    seen = rng.random((len(q), 16)) < 0.6
    spread = np.abs(x / 2 - x.mean(axis=0) / 2).max() * 2
    scale, measured, plain = 2.0 ** -np.ceil(np.log2(spread)), [], V._distances
    monkeypatch.setattr(V, "_distances", lambda d: measured.append(len(d)) or plain(d))
    best = V.Best(q_ids, q, np.packbits(seen, axis=1), k, V._mover(x.mean(axis=0), scale), scale)
    for at in range(0, n, 1000):
        best.meet(ids[at:at + 1000], cell[at:at + 1000], x[at:at + 1000])
    got = {}
    for query, own, score in zip(*[c.to_pylist() for c in best.rows().columns], strict=True):
        got.setdefault(query, []).append((score, own))
    for i in range(len(q)):
        met = np.flatnonzero(seen[i, cell] & (ids != q_ids[i]))
        want = sorted(zip(plain(q[i] - x[met]).tolist(), ids[met].tolist(), strict=True))[:k]
        assert want == got[q_ids[i]][:k] or list(q_ids).count(q_ids[i]) > 1
    assert sum(measured) < (0.1 if size > 1e-30 else 1) * n * len(q)


def test_blocks_of_queries_give_what_one_gives(spark):
    """Queries that come in many blocks; entries are shuffled once, and not with every pack of queries."""
    rows = rows_of()
    df = spark.createDataFrame(rows, VEC)
    got = V.search_every(df, 20, shard_rows=50, query_block=4).collect()
    assert sorted(map(tuple, got)) == sorted(exact(rows, 20))


def test_the_sample_is_that_of_all_rows(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i % 900, v) for i, v in enumerate(rng.normal(size=(3000, 3)).tolist())], "vec_id long, v array<double>")
    from pyspark.sql import functions as F
    for sample in (40, 700):
        want = df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
        some = V._smallest(df, 3000, sample)
        key = df.select(F.xxhash64("vec_id").alias("h"), "v").collect()
        of = {tuple(r["v"]): r["h"] for r in key}
        assert sorted(of[tuple(v)] for v in some) == sorted(of[tuple(r["v"])] for r in want)
