"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut in two halves, each quantised by its own k-means codebook (``CENTROIDS``
each, fitted on at most ``SAMPLE`` vectors chosen by hash). A pair of centroids is a
cell; a vector lies in the cell of its two nearest ones. A query walks the cells in
order of summed distance (the multi-sequence order) until the cells met
hold ``max(LEAST, share * rows)`` entries, and reranks those by exact Euclidean
distance on the original vectors, in double precision.

``share`` is set for recall: vectors without much structure, such as those of the tests
(64 dimensions, the nearest neighbour hardly nearer than the hundredth), need about half of
the cells for a recall of 0.9; on well clustered vectors a few hundredths do.

Scale: every row is indexed. Entries are written once, by cell, in shards of about ``SHARD_ROWS``
(a larger cell, such as that of one very common vector, is split by hash). Queries, with the cells they visit, are
written, too, and taken in blocks of ``QUERY_BLOCK``: a block goes to all tasks, and each reads its part of the
entries once, keeping the best of each query as it goes, so neither queries nor entries are shuffled for one another and a
task gives ten rows a query. A chunk of entries meets only the queries that visit one of its cells, by a product in single
precision whose rounding is bounded; what may be among a query's best by that is measured in doubles, and of equal vectors
of a batch only those that can be. Only the codebooks, the number of entries a cell (at most ``CENTROIDS`` squared) and one
block of queries are on the driver.

Codebooks and cells are of vectors moved by the sample's mean and scaled by a power of two, so
neither an offset common to all vectors nor their magnitude spoils them. What is reranked is
chosen by distances with a bound on their rounding, so no nearer vector is lost to it; the
score is the plain sum over the components, or, where its squares would leave the range of
doubles, that of the components divided by the largest one.

Vectors that are null, zero, of another length than most (distances between lengths are not
defined; ``Index.other_lengths`` counts them), or that hold a null or non-finite component take
no part, nor do null ids. Every row is a candidate, also if rows repeat an
id, but for those with the query's id; a query id that repeats asks with its smallest
vector. Ties go to the smaller id. With few rows every cell is visited: the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage

CENTROIDS = 64
SAMPLE = 16_384
LEAST = 10_000
SHARE = 0.5
SHARD_ROWS = 4096
QUERY_BLOCK = 16_384
CHUNK_ROWS = 512  # entries that meet a block at a time
CHUNK_QUERIES = 2048
_SAFE = 1e15  # scaled components up to which sums of squares are taken in single precision
_LARGE = 1e140  # scaled components beyond are cut to it and always reranked
_EPS = np.finfo(np.float64).eps
_EPS32 = float(np.finfo(np.float32).eps)
_NONE = np.iinfo(np.int64).max


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v: array of doubles, or of floats as they are) of the rows that take part."""
    plain = df.schema[vector_col].dataType == T.ArrayType(T.FloatType())
    vector = F.col(vector_col) if plain else F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", odd)
                       & F.exists("v", lambda x: x != 0))
    return rows


def _kmeans(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from spread starts; the same result for the same points."""
    rng = np.random.default_rng(0)
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    centroids = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        n = np.bincount(nearest, minlength=k)[:, None]
        centroids = np.where(n > 0, sums / np.maximum(n, 1), centroids)
    return centroids


def _gaps(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of points to centroids."""
    d = (points ** 2).sum(1)[:, None] + (centroids ** 2).sum(1)[None] - 2 * points @ centroids.T
    return np.maximum(d, 0.0)


def _bounds(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above the squared distances of moved vectors, whatever the rounding of these sums."""
    with np.errstate(over="ignore", invalid="ignore"):
        qq, xx = (q ** 2).sum(1)[:, None], (x ** 2).sum(1)[None]
        rough = qq + xx - 2 * q @ x.T
        # moving rounds each component by an eps of its own size, which this covers, too
        slack = 8 * (q.shape[1] + 4) * _EPS * (qq + xx) + 1e-300
        low, high = rough - slack, rough + slack
    cut = (np.abs(q).max(axis=1, initial=0.0) >= _LARGE)[:, None] | (np.abs(x).max(axis=1, initial=0.0) >= _LARGE)[None]
    return np.where(cut, -np.inf, low), np.where(cut, np.inf, high)


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return _gaps(points, centroids).argmin(axis=1)


def visit(a: np.ndarray, b: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells i * len(b) + j in ascending a[i] + b[j], up to that which makes the entries ``enough``."""
    first, second = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    # of equal sums, as a heap of (sum, rank, rank) gives them
    order = np.argsort((a[first][:, None] + b[second][None]).ravel(), kind="stable")
    cells = first[order // len(b)] * len(b) + second[order % len(b)]
    cells = cells[counts[cells] > 0]
    held = np.cumsum(counts[cells])
    return cells[:np.searchsorted(held, enough) + 1].tolist() if enough > 0 else []


def _distances(difference: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows: the plain sum, in the order of the components (the same everywhere); where squares
    are too large or too small, of the scaled components."""
    with np.errstate(over="ignore", under="ignore"):
        square = np.zeros(len(difference))
        for column in np.ascontiguousarray(difference.T):
            square += column ** 2
        out = np.sqrt(square)
        top = np.abs(difference).max(axis=1, initial=0.0)
        odd = np.flatnonzero((top > 1e150) | ((top > 0) & (top < 1e-150)))
        if len(odd):
            unit = difference[odd] / top[odd, None]
            out[odd] = top[odd] * np.sqrt((unit ** 2).sum(axis=1))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64, copy=False)


def _mover(centre: np.ndarray, scale: float):
    """Vectors less the centre, scaled, with components cut to ``_LARGE``."""
    def moved(v: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.clip((v * scale) - (centre * scale) if scale < 1 else (v - centre) * scale, -_LARGE, _LARGE)
    return moved


class Index:
    """Codebooks, cell counts and the layout of shards (all of bounded size), and the entries, by shard and cell."""

    def __init__(self, rows: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS):
        widths = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
        most = widths.orderBy(F.col("n").desc(), "width").first()
        self.width = most["width"] if most else 0
        self.rows = most["n"] if most else 0
        if not self.rows:
            return
        self.other_lengths = rows.filter(F.size("v") != self.width).count()
        rows = rows.filter(F.size("v") == self.width)
        points = np.array(_smallest(rows, self.rows, sample).tolist(), dtype=np.float64)
        half = max(1, self.width // 2)
        self.centre = (points / len(points)).sum(axis=0)
        spread = np.abs(points / 2 - self.centre / 2).max(initial=0.0) * 2
        self.scale = 2.0 ** -np.clip(np.ceil(np.log2(spread)), -1000, 1000) if 0 < spread < np.inf else 2.0 ** -1000 if spread else 1.0
        points = _mover(self.centre, self.scale)(points)
        self.books = [_kmeans(points[:, :half], centroids)]
        self.books.append(_kmeans(points[:, half:], centroids) if half < self.width else np.zeros((1, 0)))
        books, width, moved = self.books, self.width, _mover(self.centre, self.scale)
        n_cells = len(books[0]) * len(books[1])

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    v = moved(_matrix(batch.column(1), width))
                    cell = _nearest(v[:, :half], books[0]) * len(books[1]) + _nearest(v[:, half:], books[1])
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32))],
                                                     ["vec_id", "v", "cell"])

        entries = rows.mapInArrow(assign, T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())]))
        self.counts = np.zeros(n_cells, np.int64)
        for cell, n in entries.groupBy("cell").agg(F.count("*")).collect():  # at most centroids ** 2
            self.counts[cell] = n
        parts = np.maximum(1, -(-self.counts // shard_rows))
        shard, held, first = 0, 0, np.zeros(n_cells, np.int64)
        for cell in range(n_cells):  # whole cells share a shard until it is full; a large cell has its own
            if parts[cell] > 1 or held + self.counts[cell] > shard_rows:
                shard, held = shard + (held > 0), 0
            first[cell] = shard
            shard, held = (shard + int(parts[cell]), 0) if parts[cell] > 1 else (shard, held + int(self.counts[cell]))
        places = F.broadcast(rows.sparkSession.createDataFrame(  # a row a cell
            [(c, int(first[c]), int(parts[c])) for c in np.flatnonzero(self.counts).tolist()], "cell int, first long, parts long"))
        shard_of = F.col("first") + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts"))
        self.entries = stage(entries.join(places, "cell").withColumn("shard", shard_of).repartition("shard").sortWithinPartitions(
            "shard", "cell").select("vec_id", "v", "cell"), "entries")


def _smallest(rows: DataFrame, n: int, sample: int):
    """Vectors of the ``sample`` rows with the smallest hash of the id, of ``n``. So that tasks send few rows, those
    below a bound that about twice as many are below; all, should they not suffice."""
    key = F.xxhash64("vec_id")
    first = lambda some: some.orderBy(key, "vec_id").limit(sample).select("v").toPandas()["v"]
    if n > 4 * sample:
        some = first(rows.filter(key < -(1 << 63) + (1 << 64) * 2 * sample // n))
        if len(some) == sample:
            return some
    return first(rows)


def _distinct(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that can be among the k best of a query, whatever its id: of equal vectors the rows of the k + 1
    smallest ids, at most k of an id."""
    odd = np.random.default_rng(0).integers(1, 1 << 62, x.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    key = (np.ascontiguousarray(x).view(np.uint64) * odd).sum(axis=1)
    order = np.lexsort((ids, key))
    key, own, at = key[order], ids[order], np.arange(len(ids))
    group = np.concatenate(([True], key[1:] != key[:-1]))
    if group.all():
        return at
    run = group | np.concatenate(([True], own[1:] != own[:-1]))
    start = np.maximum.accumulate(np.where(group, at, 0))
    nth_id = np.cumsum(run) - np.cumsum(run)[start]
    nth = at - np.maximum.accumulate(np.where(run, at, 0))
    inner = np.flatnonzero(~group)
    equal = np.ones(len(ids), bool)
    equal[inner] = (x[order[inner]] == x[order[start[inner]]]).all(axis=1)
    return np.sort(order[~equal | (nth_id <= k) & (nth < k)])


class Best:
    """The k nearest of a block of queries among the entries met so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, seen: np.ndarray, k: int, moved, scale: float):
        self.ids, self.q, self.seen, self.k, self.moved, self.scale = ids, q, seen, k, moved, scale
        self.z = moved(q)
        self.scores, self.found = np.full((len(q), k), np.inf), np.full((len(q), k), _NONE)
        self.n = np.zeros(len(q), np.int64)
        self.edge = np.full(len(q), np.inf)  # of moved vectors, squared: none farther can be among the best
        self.safe = np.abs(self.z).max(axis=1, initial=0.0) <= _SAFE
        z = np.where(self.safe[:, None], self.z, 0.0)
        self.slack = 4 * (q.shape[1] + 8) * _EPS32
        self.half = (1 - self.slack) * (z ** 2).sum(axis=1) / 2
        self.single = np.concatenate([z, np.full((len(z), 1), -1.0)], axis=1).astype(np.float32)

    def visits(self, queries: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return (self.seen[queries, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 != 0

    def meet(self, ids: np.ndarray, cell: np.ndarray, x: np.ndarray) -> None:
        """Entries, those of a cell together."""
        keep = _distinct(ids, x, self.k)
        ids, cell, x = ids[keep], cell[keep], x[keep]
        for at in range(0, len(ids), CHUNK_ROWS):
            part = slice(at, at + CHUNK_ROWS)
            self._chunk(ids[part], cell[part], x[part])

    def _chunk(self, ids: np.ndarray, cell: np.ndarray, x: np.ndarray) -> None:
        cells = np.unique(cell)
        z = self.moved(x)
        row_safe = np.abs(z).max(initial=0.0) <= _SAFE
        half = (1 - self.slack) * (z ** 2).sum(axis=1, keepdims=True) / 2 if row_safe else None
        single = np.concatenate([z, half], axis=1).astype(np.float32).T if row_safe else None
        every = np.arange(len(self.ids))
        active = np.flatnonzero(self.visits(every[:, None], cells[None]).any(axis=1))
        fast = active[self.safe[active] & (self.n[active] == self.k)] if row_safe else active[:0]
        met = [self._single(fast[i:i + CHUNK_QUERIES], single, z) for i in range(0, len(fast), CHUNK_QUERIES)]
        slow = np.setdiff1d(active, fast, assume_unique=True)
        met += [self._double(slow[i:i + CHUNK_ROWS], ids, cell, z) for i in range(0, len(slow), CHUNK_ROWS)]
        if not met:
            return
        rows, cols = np.concatenate([m[0] for m in met]), np.concatenate([m[1] for m in met])
        good = self.visits(rows, cell[cols]) & (self.ids[rows] != ids[cols])
        rows, cols = rows[good], cols[good]
        score = np.empty(len(rows))
        with np.errstate(over="ignore"):
            for at in range(0, len(rows), 4096):
                part = slice(at, at + 4096)
                score[part] = _distances(self.q[rows[part]] - x[cols[part]])
        good = score <= self.scores[rows, -1]
        self._merge(rows[good], ids[cols[good]], score[good])

    def _single(self, queries: np.ndarray, single: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that may be among the best, by products in single precision; where these tell little, in double."""
        least = self.half[queries] - (self.edge[queries] + 1e-25) / 2
        least = np.nextafter(np.maximum(least, -3e38).astype(np.float32), np.float32(-np.inf))
        rows, cols = np.nonzero(self.single[queries] @ single >= least[:, None])
        if len(rows) > 0.1 * len(queries) * len(z):
            rows, cols = np.nonzero(_bounds(self.z[queries], z)[0] <= self.edge[queries, None])
        return queries[rows], cols

    def _double(self, queries: np.ndarray, ids: np.ndarray, cell: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same in double precision, with an edge from the entries themselves."""
        least, most = _bounds(self.z[queries], z)
        away = ~self.visits(queries[:, None], cell[None]) | (self.ids[queries][:, None] == ids[None])
        least[away] = most[away] = np.inf
        at = min(self.k, len(ids)) - 1
        edge = np.partition(most, at, axis=1)[:, at] if len(ids) >= self.k else np.inf
        edge = np.minimum(edge, self.edge[queries])
        rows, cols = np.nonzero((least <= edge[:, None]) & ~away)
        return queries[rows], cols

    def _merge(self, rows: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(rows):
            return
        who, place = np.unique(rows, return_inverse=True)
        old, nth = np.nonzero(np.arange(self.k)[None] < self.n[who, None])
        place = np.concatenate([place, old])
        ids = np.concatenate([ids, self.found[who[old], nth]])
        score = np.concatenate([score, self.scores[who[old], nth]])
        order = np.lexsort((ids, score, place))
        place, ids, score = place[order], ids[order], score[order]
        nth = np.arange(len(place)) - np.searchsorted(place, place)
        top = nth < self.k
        self.scores[who[place[top]], nth[top]], self.found[who[place[top]], nth[top]] = score[top], ids[top]
        self.n[who] = np.minimum(np.bincount(place, minlength=len(who)), self.k)
        with np.errstate(over="ignore", under="ignore"):
            self.edge[who] = (self.scores[who, -1] * self.scale) ** 2 * (1 + 1e-12) + 1e-300

    def rows(self) -> pa.RecordBatch:
        rows, nth = np.nonzero(np.arange(self.k)[None] < self.n[:, None])
        return pa.RecordBatch.from_arrays([pa.array(self.ids[rows]), pa.array(self.found[rows, nth]), pa.array(self.scores[rows, nth])],
                                          ["query_id", "vec_id", "score"])


def search(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           share: float = SHARE, least: int = LEAST, centroids: int = CENTROIDS, sample: int = SAMPLE,
           shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row of ``queries`` (columns as ``df``) the k nearest
    found among the rows of ``df`` with another id; score is the Euclidean distance."""
    spark = df.sparkSession
    index = Index(usable(df, id_col, vector_col), centroids, sample, shard_rows)
    kinds = "query_id long, rank int, vec_id long, score double"
    if not index.rows:
        return spark.createDataFrame([], kinds)
    width, half, books, scale, moved = index.width, max(1, index.width // 2), index.books, index.scale, _mover(index.centre, index.scale)
    counts, enough = index.counts, max(least, int(np.ceil(share * index.rows)))
    asked = usable(queries, id_col, vector_col)
    asked = asked.filter(F.size("v") == width).groupBy("vec_id").agg(F.min("v").alias("v"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the cells they visit, a bit for each."""
        for batch in batches:
            z = moved(_matrix(batch.column(1), width))
            a, b = _gaps(z[:, :half], books[0]), _gaps(z[:, half:], books[1])
            bits = []
            for i in range(len(z)):
                seen = np.zeros(len(counts), bool)
                seen[visit(a[i], b[i], counts, enough)] = True
                bits.append(np.packbits(seen).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], ["vec_id", "v", "seen"])

    asked = stage(asked.mapInArrow(walk, T.StructType([*asked.schema.fields, T.StructField("seen", T.BinaryType())])), "asked")
    blocks = -(-asked.count() // query_block)

    def nearest(block: int) -> DataFrame:
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        ids, seen = own.column(0).to_numpy(), [np.frombuffer(bits, np.uint8) for bits in own.column(2).to_pylist()]
        sent = spark.sparkContext.broadcast((ids, _matrix(own.column(1).combine_chunks(), width), np.array(seen)) if len(ids) else None)

        def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = None
            for batch in batches:
                if len(batch) and sent.value is not None:
                    best = best or Best(*sent.value, k, moved, scale)
                    best.meet(batch.column(0).to_numpy(), batch.column(2).to_numpy(), _matrix(batch.column(1), width))
            if best is not None:
                yield best.rows()

        found = index.entries.mapInArrow(rerank, "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        found = stage(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score"), "nearest")
        sent.destroy()
        return found

    if not blocks:
        return spark.createDataFrame([], kinds)
    return reduce(DataFrame.unionAll, [nearest(block) for block in range(blocks)])


def search_every(df: DataFrame, every: int, k: int = 10, id_col: str = "vec_id", **options) -> DataFrame:
    """``search`` for the rows whose id is divisible by ``every``, against all rows."""
    return search(df, df.filter(F.col(id_col) % every == 0), k, id_col, **options)
