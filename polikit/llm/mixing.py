"""Mixing sources to target weights by entropy balancing.

A source's target is its share, by weight, of ``share`` times all words, at most
``MOST`` times what it has; what that leaves over is shared out again by weight.

Rates minimise the relative entropy to one copy each under a word constraint a source
and the bound ``MOST``: a document of x words gets ``min(MOST, exp(theta * x))``, with
one theta a source. The convex dual falls apart by source; safeguarded Newton steps
solve all sources at once, each step one grouped aggregation. Only sizes matter, so the
steps run over a table of (source, size, documents), not over documents. Sums are decimals,
so reruns agree to the last bit.

Rates become copies (0, 1 or 2) by thresholds: copy k of a document is taken if its rate
passes k - 1 + u, u being uniform by hash of id and text. A shift of all thresholds of a
source, found by refining histograms of (threshold - rate), makes the words taken stop
just short of the target; further shifts, for documents that fit in the rest, fill it up.

Scale: state is one row a source, counted before it is broadcast; a source with a third
of all rows is pre-aggregated in every step; texts are read twice and never shuffled.

Null texts have size 0; a null source is a source, last in order; null ids and repeated rows
take part (equal rows move together). A source without words has target 0 and takes none.
An empty table gives an empty result. Other columns are carried by ``mixed`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, broadcast_if_small, stage

SHARE = 1.5
MOST = 2
WEIGHTS = (3, 1, 2)
NEWTON_STEPS = 40
NEAR = 1e-5  # of the target: the tilt is found; rounding evens out the rest
BINS = 1 << 13
ROUNDS = 4
LEVELS = 3
NEAR_SHARE = 1e-4  # of the target: near enough for a source
_WORD = r"[^\x20\x09-\x0D]+"
_SUM = "decimal(38,9)"


def _few(df: DataFrame, rows: int) -> DataFrame:
    """A table known to have few rows, in one partition: its later steps are one task each."""
    return df.coalesce(1) if rows <= BROADCAST_ROWS else df


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _place(id_col: str, text_col: str) -> Column:
    """u: uniform in [0, 1) by id and text."""
    bits = F.shiftrightunsigned(F.xxhash64(F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def _ordered(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``sources`` with ``weight``, given out in turn by code point, null last: range-partitioned,
    with one count a partition for the places before it."""
    order = F.col("source").asc_nulls_last()
    held = stage(sources.repartitionByRange(order).sortWithinPartitions(order).select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), "sources")
    counts = held.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    at = (F.col("before") + F.col("pos")) % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), at.cast("int"))
    return held.join(F.broadcast(before), "part").select("source", "source_size", weight.alias("weight"))


def targets(sizes: DataFrame, share: float = SHARE, most: int = MOST,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from rows of (source, size). Only sums go to the driver."""
    of = stage(_ordered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights), "weights")
    cap = F.col("source_size") * most
    total, weight = of.agg(F.sum("source_size"), F.sum("weight")).first()
    level, stopped = 0.0, -1
    while total:
        full = cap < F.col("weight") * F.lit(level)
        n, words, own = of.filter(full).agg(F.count("*"), F.sum(cap), F.sum("weight")).first()
        if n == stopped:
            break
        left = weight - (own or 0.0)
        if left <= 0:
            level = float("inf")
            break
        level, stopped = (share * total - (words or 0)) / left, n
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level)) if total else F.lit(0.0)
    return of.select("source", "source_size", target.alias("target"))


def _rate(size: Column, theta: Column, most: int) -> Column:
    return F.when(theta.isNull(), F.lit(float(most))).otherwise(F.exp(F.least(theta * size, F.lit(50.0)))).cast("double")


def tilts(sizes: DataFrame, aims: DataFrame, most: int = MOST) -> DataFrame:
    """``aims`` with theta: the tilt at which the source's rates take its target (null: all rates
    are ``most``)."""
    counts = stage(sizes.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    mean = counts.groupBy("source").agg((F.sum(F.col("size") * F.col("size") * F.col("n"))
                                         / F.sum(F.col("size") * F.col("n"))).alias("typical"))
    aims_, mean_ = aims.alias("a"), mean.alias("m")
    state = aims_.join(mean_, F.col("a.source").eqNullSafe(F.col("m.source")), "left").select("a.*", "typical")
    full = F.col("target") >= F.col("source_size") * most
    start = F.log(F.col("target") / F.col("source_size")) / F.col("typical")
    state = state.withColumn("theta", F.when(full | F.col("typical").isNull() | (F.col("target") <= 0), F.lit(None))
                             .otherwise(start)).withColumn("low", F.lit(None).cast("double"))
    n = aims.count()
    state = state.withColumn("high", F.lit(None).cast("double")).withColumn("done", F.col("theta").isNull())
    state = stage(_few(state, n), "tilt")
    for _ in range(NEWTON_STEPS):
        if state.filter("not done").isEmpty():
            break
        open_ = broadcast_if_small(state.filter("not done").select(F.col("source").alias("source_"), "theta"), n)
        x, e = F.col("size"), F.exp(F.least(F.col("theta") * F.col("size"), F.lit(50.0)))
        words, free = x * F.col("n") * F.least(e, F.lit(float(most))), e < most
        slope = F.when(free, x * x * F.col("n") * e).otherwise(0.0)
        met = (counts.join(open_, F.col("source").eqNullSafe(F.col("source_"))).groupBy("source")
               .agg(F.sum(words.cast(_SUM)).cast("double").alias("words"), F.sum(slope.cast(_SUM)).cast("double").alias("slope"))
               .withColumnRenamed("source", "source_"))
        met = broadcast_if_small(_few(met, n), n)
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("theta")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("theta")).otherwise(F.col("high"))
        step = F.col("theta") - gap / F.col("slope")
        wide = F.lit(2.0) / F.col("typical")
        middle = (F.when(low.isNull(), high - wide).when(high.isNull(), low + wide).otherwise((low + high) / 2))
        inside = ((F.col("slope") > 0) & (low.isNull() | (step > low)) & (high.isNull() | (step < high))
                  & (F.abs(step - F.col("theta")) <= wide * 4))
        near = F.abs(gap) <= F.lit(NEAR) * F.col("target")
        halted = low.isNotNull() & high.isNotNull() & ((high - low) * F.col("typical") < 1e-13)
        moved = state.join(met, F.col("source").eqNullSafe(F.col("source_")), "left")
        going = F.col("words").isNotNull()
        state = stage(_few(moved, n).select(
            "source", "source_size", "target", "typical",
            F.when(going & ~near & ~halted, F.when(inside, step).otherwise(middle)).otherwise(F.col("theta")).alias("theta"),
            F.when(going, low).otherwise(F.col("low")).alias("low"), F.when(going, high).otherwise(F.col("high")).alias("high"),
            (F.col("done") | near | halted).alias("done")), "tilt")
    return state.select("source", "source_size", "target", "theta")


def _thresholds(u: Column, rate: Column, most: int) -> Column:
    """Where the shift must lie above for each copy."""
    return F.array(*[F.lit(float(k)) + u - rate for k in range(most)])


def _own_shift(size: Column, steps: Column) -> Column:
    """The shift of a document of this size: the largest of the steps that reach its size."""
    return F.array_max(F.transform(F.filter(steps, lambda s: size <= s["upto"]), lambda s: s["shift"]))


def _refined(places: DataFrame, state: DataFrame, most: int, n: int) -> DataFrame:
    """``state`` with the interval [low, high) of thresholds in which the words taken pass the
    target, narrowed until it holds ``NEAR_SHARE`` of the target or so: under is the words
    taken below it, mass those in it. ``n``: the number of sources."""
    for _ in range(ROUNDS):
        wide = F.col("mass") > F.greatest(F.lit(1.0), F.lit(NEAR_SHARE) * F.col("target"))
        if state.filter(wide).isEmpty():
            break
        side = broadcast_if_small(state.filter(wide).select(
            F.col("source").alias("source_"), "theta", "low", "high", "limit", "steps"), n)
        near = places.filter("size > 0").join(side, F.col("source").eqNullSafe(F.col("source_"))).filter("size <= limit")
        rate = F.least(_rate(F.col("size"), F.col("theta"), most), F.lit(float(most)))
        bin_ = F.floor((F.col("z") - F.col("low")) / (F.col("high") - F.col("low")) * BINS)
        sums = (near.select("source", "size", "low", "high", _own_shift(F.col("size"), F.col("steps")).alias("own"),
                            F.explode(_thresholds(F.col("u"), rate, most)).alias("z"))
                .filter("z >= low and z < high and (own is null or z >= own)")
                .groupBy("source", F.least(bin_, F.lit(BINS - 1)).alias("bin")).agg(F.sum("size").alias("words")))
        sums = _few(sums, n * BINS)
        # at most BINS rows a source; the bin in which the running sum passes the target
        run = Window.partitionBy("source").orderBy("bin")
        sums = sums.select(F.col("source").alias("source_"), "bin", "words", F.sum("words").over(run).alias("upto"))
        goal = broadcast_if_small(state.select("source", (F.col("target") - F.col("under")).alias("left")), n)
        passed = sums.join(goal, F.col("source_").eqNullSafe(F.col("source"))).filter(F.col("upto") >= F.col("left"))
        hit = broadcast_if_small(passed.groupBy("source_").agg(F.min(F.struct("bin", "words", "upto")).alias("hit")), n)
        unit = (F.col("high") - F.col("low")) / BINS
        here, at = F.col("hit").isNotNull(), F.col("hit.bin")
        moved = state.join(hit, F.col("source").eqNullSafe(F.col("source_")), "left").withColumn("wide", wide)
        state = stage(_few(moved, n).select(
            "source", "source_size", "target", "theta", "steps", "limit",
            F.when(here, F.col("low") + unit * at).otherwise(F.col("low")).alias("low"),
            F.when(here, F.col("low") + unit * (at + 1)).otherwise(F.col("high")).alias("high"),
            F.when(here, F.col("under") + F.col("hit.upto") - F.col("hit.words")).otherwise(F.col("under")).alias("under"),
            # where no bin passes the target, all that is left is taken: the interval's upper end
            F.when(here, F.col("hit.words")).when(F.col("wide"), F.lit(0)).otherwise(F.col("mass")).alias("mass")), "shift")
    return state


def shifts(places: DataFrame, tilted: DataFrame, most: int = MOST) -> DataFrame:
    """``tilted`` with steps, an array of (upto, shift): documents of at most ``upto`` words get
    that shift. ``places``: (source, size, u).

    The first step is for all documents and stops before the document with which the words
    taken would pass the target. The next ones go on with the documents that fit in what is
    left, so the remainder shrinks to a small document even where documents are large. The last
    goes on to documents of twice that: with one of them the words taken are as near or nearer."""
    n = tilted.count()
    state = tilted.select("source", "source_size", "target", "theta", F.lit(0).cast("long").alias("under"),
                          F.expr("cast(array() AS array<struct<upto:bigint,shift:double>>)").alias("steps"))
    for level in range(LEVELS):
        left = F.col("target") - F.col("under")
        limit = F.lit(2 ** 62) if level == 0 else F.floor(left) if level < LEVELS - 1 else F.floor(2 * left)
        short = (left > F.lit(NEAR_SHARE) * F.col("target")) & (F.col("target") > 0)
        state = stage(_few(state, n).select(
            "source", "source_size", "target", "theta", "steps", "under", limit.cast("long").alias("limit"),
            F.lit(-float(most) - 1).alias("low"), F.lit(float(most) + 1).alias("high"),
            F.when(short, F.col("source_size") * most).otherwise(F.lit(0)).cast("long").alias("mass")), "shift")
        before = broadcast_if_small(state.select(F.col("source").alias("source_"), (F.col("mass") > 0).alias("open")), n)
        state = _refined(places, state, most, n).join(before, F.col("source").eqNullSafe(F.col("source_")))
        # under is what is taken without the interval; the last level may take it if that is nearer
        nearer = F.lit(level == LEVELS - 1) & (left > F.col("under") + F.col("mass") - F.col("target"))
        kept = F.when((F.col("mass") > 0) & ~nearer, F.col("low")).otherwise(F.col("high"))
        step = F.array(F.struct(F.col("limit").alias("upto"), kept.alias("shift")))
        state = state.select("source", "source_size", "target", "theta", "under",
                             F.when(F.col("open"), F.concat("steps", step)).otherwise(F.col("steps")).alias("steps"))
    return stage(state.drop("under"), "shifts")


def _copies(size: Column, u: Column, most: int) -> Column:
    rate = F.least(_rate(size, F.col("theta"), most), F.lit(float(most)))
    own = _own_shift(size, F.col("steps"))
    passed = F.filter(_thresholds(u, rate, most), lambda z: z < own)
    plain = F.when(F.col("target") <= 0, F.lit(0)).otherwise(F.size(passed))
    return F.when(size > 0, plain).otherwise(F.lit(1))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """(places, state): the rows of (id_col, source, size, u), and (source, source_size, target, theta,
    steps). ``most`` is the largest number of copies."""
    places = stage(docs.select(F.col(id_col), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                               _place(id_col, text_col).alias("u")), "places")
    aims = stage(targets(places, share, most, weights), "targets")
    return places, shifts(places, tilts(places, aims, most), most)


def _beside(rows: DataFrame, state: DataFrame) -> DataFrame:
    side = broadcast_if_small(state.withColumnRenamed("source", "source_"))
    return rows.join(side, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")


def mix_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per row: id_col, size, source_size, target (its source's), taken (words, repeats counted)."""
    places, state = plan(docs, id_col, text_col, source_col, share, most, weights)
    return _beside(places, state).select(
        id_col, "size", "source_size", "target",
        (F.col("size") * _copies(F.col("size"), F.col("u"), most)).cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken. A row without words stays once."""
    _, state = plan(docs, id_col, text_col, source_col, share, most, weights)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{source_col}`").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"),
                       _place(id_col, text_col).alias("u"))
    copies = _copies(F.col("size"), F.col("u"), most)
    taken = _beside(rows, state).select("row", copies.alias("copies")).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
