"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

Texts become words (lower-cased runs of letters and digits). A *mask* such as
``110100111`` slides over them and hashes the words under its ones; words under its
zeros may be anything, so one substitution does not hide an overlap from all masks. Items
and documents are hashed at every position. ``MASKS`` are complete for ``WINDOW`` and ``AGREE``:
whichever words of a window that verification accepts are substituted, one of the masks lies
on agreeing words only. For items of fewer words, and for other windows, ``more_masks`` adds
the masks that are missing, so that every overlap that verification accepts is looked at. Equal hashes give a document,
an item and a diagonal (how far the item is shifted against the document).

Every diagonal found is then verified on the words themselves: some ``WINDOW`` consecutive
words of the item (all, if it has fewer) must agree with the document in at least
``AGREE`` of their places. An insertion splits an overlap into two diagonals, each verified.

Scale: the large side is never shuffled in the usual case. Seeds and candidates are
counted and broadcast if small; else the same joins shuffle. A passage that a third of all
documents quote is a handful of seeds, and its hits shrink to one row a document and
diagonal before they leave the task.

Null and empty texts and items match nothing; items of no words neither. A null doc_id is an
id like any other. Rows that repeat both id and text count once. Other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, broadcast_if_small, stage

MASKS = ("11101011", "110100111")
STRIDE = 1
WINDOW = 13
AGREE = 0.8
_PATTERNS = 10_000  # places of substitutions that are enumerated
_NO_SEEDS = "cast(array() as array<struct<pos:int,seed:bigint>>)"
_SPLIT = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SPLIT), "")


def _hashed(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _seeds(masks: list[str], stride: int) -> Column:
    """array<struct<pos, seed>> of column ``h`` under all masks."""
    def under(mask: str) -> Column:
        ones = [i for i, c in enumerate(mask) if c == "1"]
        last = F.size("h") - len(mask)
        at = lambda p: F.struct(p.alias("pos"), F.xxhash64(
            F.lit(mask), *[F.get("h", p + o) for o in ones]).alias("seed"))
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last, F.lit(stride)), at))

    return F.concat(*[F.coalesce(under(m), F.expr(_NO_SEEDS)) for m in masks])


def _need(window: Column, agree: float) -> Column:
    return F.ceil(window * F.lit(agree) - F.lit(1e-9)).cast("int")


def more_masks(n: int, wrong: int, masks: tuple[str, ...]) -> list[str]:
    """Masks to add to ``masks`` so that, whichever ``wrong`` of ``n`` words differ, one mask lies
    at some place on none of them."""
    if math.comb(n, wrong) > _PATTERNS:  # so many agreeing words in a row there are always
        return ["1" * math.ceil((n - wrong) / (wrong + 1))]
    placed = [{i + k for k, c in enumerate(m) if c == "1"} for m in masks for i in range(n - len(m) + 1)]
    left = [set(p) for p in combinations(range(n), wrong) if all(m & set(p) for m in placed)]
    out = []
    while left:
        zeros = set(left[0])
        for p in left:
            if len(zeros | p) <= n // 3:
                zeros |= p
        out.append("".join("0" if k in zeros else "1" for k in range(n)))
        left = [p for p in left if not p <= zeros]
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", masks: tuple[str, ...] = MASKS,
             stride: int = STRIDE, window: int = WINDOW, agree: float = AGREE) -> DataFrame:
    """(id, tie, item_id, matched, window, start): verified overlaps, the best place of each
    document and item. ``tie`` is the hash of the text: with the id it names the row."""
    items = stage(benchmark.select(F.col(item_col).alias("item_id"), _hashed(F.col(item_text_col)).alias("h"))
                  .filter("size(h) > 0").distinct(), "items")
    wide = F.least(F.size("h"), F.lit(window))
    sizes = [r[0] for r in items.select(wide).distinct().collect()]  # at most ``window`` numbers
    more = {n: more_masks(n, n - math.ceil(n * agree - 1e-9), masks) for n in sorted(sizes)}
    own = [F.when(wide == n, _seeds(found, 1)).otherwise(F.expr(_NO_SEEDS)) for n, found in more.items() if found]
    all_seeds = F.concat(_seeds(list(masks), 1), *own)
    extra = list(dict.fromkeys(m for found in more.values() for m in found))
    seeds = stage(items.select("item_id", F.size("h").alias("n"), F.explode(all_seeds).alias("s")).select(
        "item_id", "n", F.col("s.pos").alias("item_pos"), F.col("s.seed").alias("seed")), "seeds")

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tied = rows.withColumn("tie", F.xxhash64("text"))
    steps = [(list(masks), stride)] + ([(extra, 1)] if extra else [])
    hashed = tied.select("id", "tie", _hashed(F.col("text")).alias("h"))
    found = hashed.select("id", "tie", F.explode(F.concat(*[_seeds(m, k) for m, k in steps])).alias("s"))
    hits = found.select("id", "tie", F.col("s.pos").alias("pos"), F.col("s.seed").alias("seed")).join(
        broadcast_if_small(seeds), "seed")
    spots = stage(hits.groupBy("id", "tie", "item_id", "n", (F.col("pos") - F.col("item_pos")).alias("shift"))
                  .agg(F.count("*").alias("seeds")), "candidates")
    n_spots = spots.count()

    spots_of = spots.groupBy("id", "tie").agg(F.collect_list(F.struct("item_id", "n", "shift")).alias("spots"))
    spots_of = spots_of.withColumnsRenamed({"id": "id_", "tie": "tie_"})
    if n_spots <= BROADCAST_ROWS:
        spots_of = F.broadcast(spots_of)
    again = tied.join(spots_of, F.col("id").eqNullSafe(F.col("id_")) & (F.col("tie") == F.col("tie_"))).select(
        "id", "tie", _hashed(F.col("text")).alias("h"), "spots")
    # of each spot the document's words beside the item: never the whole document for each
    cut = F.transform("spots", lambda s: F.struct(
        s["item_id"].alias("item_id"), s["shift"].alias("shift"),
        F.slice("h", F.greatest(s["shift"], F.lit(0)) + 1, s["n"] + F.least(s["shift"], F.lit(0))).alias("part")))
    beside = again.select("id", "tie", F.explode(cut).alias("s")).select("id", "tie", "s.*")
    beside = beside.join(broadcast_if_small(items.withColumnRenamed("h", "item")), "item_id")
    skipped = F.greatest(-F.col("shift"), F.lit(0))  # words of the item before the document's first
    same = F.zip_with("part", F.slice("item", skipped + 1, F.size("part")),
                      lambda a, b: F.when(a == b, 1).otherwise(0))
    wide = F.least(F.size("item"), F.lit(window))
    scored = beside.select("id", "tie", "item_id", "shift", skipped.alias("skipped"), same.alias("same"), wide.alias("window"))
    scored = scored.filter(F.size("same") >= F.col("window"))
    sums = F.transform(F.sequence(F.lit(0), F.size("same") - F.col("window")), lambda s: F.struct(
        F.aggregate(F.slice("same", s + 1, F.col("window")), F.lit(0), lambda a, b: a + b).alias("matched"),
        (-(s + F.col("skipped") + F.col("shift"))).alias("back")))
    best = scored.select("id", "tie", "item_id", "window", F.array_max(sums).alias("best"))
    return (best.filter(F.col("best.matched") >= _need(F.col("window"), agree))
            .groupBy("id", "tie", "item_id", "window").agg(F.max("best").alias("best"))
            .select("id", "tie", "item_id", F.col("best.matched").alias("matched"), "window",
                    (-F.col("best.back")).alias("start")))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document id and item with a verified overlap: id_col, item_id, matched words of
    the window, window, start (the window's first word in the document, counted from 0)."""
    if id_col in ("item_id", "matched", "window", "start"):
        raise ValueError(f"{id_col} is the name of another column of the result")
    found = overlaps(docs, benchmark, id_col, **options)
    best = found.groupBy("id", "item_id", "window").agg(
        F.max(F.struct("matched", (-F.col("start")).alias("back"))).alias("best"))
    return best.select(F.col("id").alias(id_col), "item_id", F.col("best.matched").alias("matched"), "window",
                       (-F.col("best.back")).alias("start"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the rows that overlap an item; all columns, repeated rows kept."""
    found = stage(overlaps(docs, benchmark, id_col, text_col, **options).select(
        F.col("id").alias("__found_id"), F.col("tie").alias("__found_tie")).distinct(), "contaminated")
    side = broadcast_if_small(found)
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__found_id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("__found_tie"))
    return docs.join(side, same, "left_anti")
