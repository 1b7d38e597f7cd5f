"""Ranked lexical search, reversed: the queries are indexed and the documents stream by.

The terms of all items (queries) form an inverted index, term to (item, repeats), which is
broadcast. One pass over the documents counts each text's terms and keeps, by document, its
length and the counts of the index's terms, staged as narrow rows; totals and document
frequencies are summed from those. A second pass streams the narrow rows through the index:
each batch of documents adds its terms' weights to the items that hold them, and a heap of
at most ``k`` entries an item takes the best. Each task gives its heaps, which are merged
by item. Documents never move.

*Bound.* The index's size is bounded before it is built: items whose texts together have more
than ``INDEX_BYTES`` are searched in blocks of items under that bound (a single longer item is
a block by itself), each with its own passes over all documents; results are the same.

*Scores.* With N documents that have a term, L their terms, n a document's terms, df the documents
with a term and tf its occurrences in one, the weight w of a term is
floor(1000 ln((2N + 2) / (2df + 1))) and a document's m is 100 - 25 + (25 n N) div L; its score is
the sum of w ((1000000000 tf) div (1000 tf + 12 m)) over the item's terms, repeats included, in 64-bit integers.

Terms are runs of ASCII letters and digits and of characters beyond ASCII; only A-Z are lower-cased.
A null text has no terms; a text without terms counts nowhere. Every row is a document, also if
ids repeat or are null (null ids last among equals). Items that repeat id and text count once;
an item without terms, or whose terms no document holds, gives no rows. Other columns are
ignored. Equal scores go by ascending document id.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, kept_in_worker, stage

INDEX_BYTES = 4 << 20  # of the texts of the items in one index
CELLS = 1 << 20  # (document, item) scores, or terms' uses in items, that are held at once
#: Letters and digits beyond 7 bits stay, A-Z become small, all other ASCII parts terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_LAST = 1 << 63  # the place of a null id among ids


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return (text or b"").translate(_FOLD).split()


class Index:
    """Items by term: for term number t the items ``items[starts[t]:starts[t + 1]]`` hold it ``repeats`` times."""

    def __init__(self, texts: list[bytes]):
        by_term: dict[bytes, list[tuple[int, int]]] = {}
        for i, text in enumerate(texts):
            for term, n in Counter(terms(text)).items():
                by_term.setdefault(term, []).append((i, n))
        self.n_items = len(texts)
        self.numbers = {term: t for t, term in enumerate(by_term)}
        posts = list(by_term.values())
        self.starts = np.cumsum([0, *map(len, posts)])
        flat = np.array([p for own in posts for p in own], np.int64).reshape(-1, 2)
        self.items, self.repeats = flat[:, 0], flat[:, 1]


def _blocks(items: DataFrame, id_col: str, text_col: str, bound: int) -> Iterator[list[tuple]]:
    """Lists of (id, text) with at most ``bound`` bytes of text each (or one item), by hash ranges
    of items: only a histogram of sizes and one block at a time come to the driver."""
    plain = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).filter("text is not null")
    plain = plain.distinct().withColumn("place", F.xxhash64("id", "text"))
    plain = stage(plain.withColumn("bytes", F.length("text")), "search-items")
    total = plain.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    shift = 64 - max(0, (8 * total // bound).bit_length())
    cell = F.shiftright("place", shift) if shift < 64 else F.lit(0).cast("long")
    sizes = plain.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("bytes")).orderBy("cell").collect()
    pending: list[int] = []
    held = 0
    for c, size in [*((r["cell"], r["bytes"]) for r in sizes), (None, bound + 1)]:
        if pending and held + size > bound:
            rows = plain.filter(cell.isin(pending))
            if held <= bound:
                yield [(r["id"], bytes(r["text"])) for r in rows.select("id", "text").collect()]
            else:  # one cell beyond the bound: its items singly
                for p in sorted(r["place"] for r in rows.select("place").distinct().collect()):
                    yield [(r["id"], bytes(r["text"])) for r in plain.filter(F.col("place") == p).select("id", "text").collect()]
            pending, held = [], 0
        pending, held = [*pending, c], held + size


def _counted(docs: DataFrame, index, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, counts) of the documents with a term: how many terms, and which of the index's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_in_worker()
        number = index.value.numbers.get
        for batch in batches:
            ids, ns, found, counts = [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = terms(text.as_py())
                if own:
                    known = Counter(map(number, own))
                    known.pop(None, None)
                    ids.append(i)
                    ns.append(len(own))
                    found.append(list(known))
                    counts.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["id", "n", "terms", "counts"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    out = plain.filter("text is not null").mapInArrow(run, "id long, n long, terms array<int>, counts array<long>")
    return stage(out, "search-counts")


def _frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """Documents by term: a task sends one number a term of the (bounded) index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_terms, np.int64)
        for batch in batches:
            sums += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["term", "df"])

    rows = counted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(n_terms, np.int64)
    out[[r["term"] for r in rows]] = [r["df"] for r in rows]
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _best(counted: DataFrame, index, weights, n_docs: int, n_terms_all: int, k: int) -> DataFrame:
    """(item, id, score): each task's ``k`` best documents an item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = index.value, weights.value
        heaps: list[list[tuple[int, int]]] = [[] for _ in range(own.n_items)]
        least = np.zeros(own.n_items, np.int64)  # a score under this has no place in the item's heap
        for batch in batches:
            step = max(1, CELLS // own.n_items)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                places = [_LAST if i is None else i for i in part.column(0).to_pylist()]
                n = part.column(1).to_numpy()
                lists = part.column(2)
                term, tf = lists.flatten().to_numpy(), part.column(3).flatten().to_numpy()
                doc = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
                m = 75 + 25 * n * n_docs // n_terms_all
                gain = w[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
                uses = own.starts[term + 1] - own.starts[term]
                scores = np.zeros(len(n) * own.n_items, np.int64)
                # as many terms at a time as have CELLS uses together, each beside all its items
                ends = np.flatnonzero(np.diff((np.cumsum(uses) - 1) // CELLS)) + 1
                for own_terms in np.split(np.arange(len(term)), ends):
                    many = uses[own_terms]
                    each = np.repeat(own_terms, many)
                    place = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + own.starts[term[each]]
                    np.add.at(scores, doc[each] * own.n_items + own.items[place], gain[each] * own.repeats[place])
                scores = scores.reshape(len(n), own.n_items)
                for d, i in zip(*np.nonzero((scores >= least) & (scores > 0)), strict=True):
                    entry, heap = (int(scores[d, i]), -places[d]), heaps[i]
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        least[i] = heap[0][0]
        rows = [(i, None if -place == _LAST else -place, score) for i, heap in enumerate(heaps) for score, place in heap]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                                          pa.array(columns[2], pa.int64())], ["item", "id", "score"])

    return counted.mapInArrow(run, "item int, id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The ``k`` best documents of each item: item id, rank, document id, score."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    item_type = dict(items.dtypes)[item_col]
    bounded_batches(spark)
    out = spark.createDataFrame([], f"{item_col} {item_type}, rank int, {id_col} long, score long")
    for block in _blocks(items, item_col, item_text_col, index_bytes):
        built = Index([text for _, text in block])
        if not built.numbers:
            continue
        index = sc.broadcast(built)
        counted = _counted(docs, index, id_col, text_col)
        n_docs, n_terms_all = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        weights = sc.broadcast(np.array([weight(n_docs, int(df)) for df in _frequencies(counted, len(built.numbers))], np.int64))
        found = _best(counted, index, weights, n_docs, n_terms_all, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, named {item_type}")
        ranked = stage(ranked.join(F.broadcast(names), "item"), "search-found")  # a number a block's item: bounded
        out = out.unionByName(ranked.select(F.col("named").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    return out
