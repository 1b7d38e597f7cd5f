"""Chat formatting by perspective rotation, with DataFrame functions only.

A dialogue of several speakers is rendered once for each of them: that speaker's turns
become the assistant's, all others' become turns of users with names, context turns
(role ``system``) stay as they are. The mask gives the spans of characters to learn from:
the assistant's words with their end mark.

    <|system|>            context, never learnt
    <|user:NAME|>         a turn of another speaker
    <|assistant|>         a turn of the speaker whose view this is
    <|end|>               after each turn

Marks that occur in a text are broken up (``<|`` becomes ``< |``).

Scale: a dialogue is rendered in parts of ``PART_TURNS`` consecutive turn numbers, so a
conversation that holds a third of all rows is many groups; where more than ``PART_TURNS``
rows share one turn number, the part is cut further, at every ``PART_TURNS``-th row of its
order (column ``piece``, from 0): its different rows are range-partitioned, and their running
places are sums of counts. The text of a view is that of its parts and pieces in order. Views
times turns rows are the result itself.

Turns are in order of turn (null first), role, text. A null text is empty, a null role is
the speaker ``unknown``, null conversation ids are one conversation, repeated rows are
repeated turns. A conversation without speakers (only context) has no view. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage

PART_TURNS = 256
CONTEXT = ("system",)
END = "<|end|>\n"


def _pieces(rows: DataFrame, size: int) -> DataFrame:
    """(conv, part, piece, turns): each part's rows in order, ``size`` a piece."""
    order = ["turn", "role", "text"]
    n_ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    different = rows.groupBy("conv", "part", *order).agg(F.count("*").alias("n"))  # repeated rows are one, n times
    ranged = stage(different.repartitionByRange(n_ranges, "conv", "part", *order)
                   .withColumn("range", F.spark_partition_id()), "chat-ranges")
    so_far = lambda by: by.rowsBetween(Window.unboundedPreceding, -1)
    held = ranged.groupBy("conv", "part", "range").agg(F.sum("n").alias("held"))
    held = held.select(
        F.col("conv").alias("conv_"), F.col("part").alias("part_"), F.col("range").alias("range_"),
        F.coalesce(F.sum("held").over(so_far(Window.partitionBy("conv", "part").orderBy("range"))), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv", "part", "range").orderBy(*order)
    placed = ranged.withColumn("within", F.coalesce(F.sum("n").over(so_far(within)), F.lit(0)))
    placed = placed.join(broadcast_if_small(stage(held, "chat-offsets")), F.col("conv").eqNullSafe(F.col("conv_")) & (
        F.col("part") == F.col("part_")) & (F.col("range") == F.col("range_")))
    placed = placed.withColumn("first", F.col("before") + F.col("within"))
    last = F.col("first") + F.col("n")
    spread = placed.select("conv", "part", *order, "first", last.alias("last"), F.explode(F.sequence(
        F.floor(F.col("first") / size), F.floor((last - 1) / size))).alias("piece"))
    times = F.least(F.col("last"), (F.col("piece") + 1) * size) - F.greatest(F.col("first"), F.col("piece") * size)
    found = spread.groupBy("conv", "part", "piece").agg(
        F.sort_array(F.collect_list(F.struct(*order, times.cast("int").alias("times")))).alias("turns"))
    return found.withColumn("turns", F.flatten(F.transform("turns", lambda t: F.array_repeat(
        F.struct(*[t[c].alias(c) for c in order]), t["times"]))))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", context: tuple[str, ...] = CONTEXT, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_col, assistant, part, piece, n_turns, text, spans: array of (start, end)) of every view."""
    safe = F.replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), safe.alias("text"))
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)))
    crowded = rows.groupBy("conv", "part", "turn").agg(F.count("*").alias("n")).filter(F.col("n") > part_turns)
    crowded = stage(crowded.select(F.col("conv").alias("conv_"), F.col("part").alias("part_")).distinct(), "crowded-parts")
    n_crowded = crowded.count()
    turn = F.struct("turn", "role", "text")
    if n_crowded:
        side = broadcast_if_small(crowded, n_crowded)
        here = F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("part") == F.col("part_"))
        pieces = _pieces(rows.join(side, here, "left_semi"), part_turns)
        rows_of = rows.join(side, here, "left_anti")
    else:
        rows_of = rows
    parts = rows_of.groupBy("conv", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = parts.select("conv", "part", F.lit(0).cast("long").alias("piece"), "turns")
    if n_crowded:
        parts = parts.unionByName(pieces)
    speakers = rows.filter(~F.col("role").isin(*context)).select(F.col("conv").alias("conv_"), F.col("role").alias("assistant")).distinct()
    views = parts.join(speakers, F.col("conv").eqNullSafe(F.col("conv_")))
    own = F.col("assistant")
    segments = F.transform("turns", lambda t: F.struct(
        F.when(t["role"] == own, "<|assistant|>\n").when(t["role"].isin(*context), F.concat(F.lit("<|"), t["role"], F.lit("|>\n")))
        .otherwise(F.concat(F.lit("<|user:"), F.replace(t["role"], F.lit("<|"), F.lit("< |")), F.lit("|>\n"))).alias("head"),
        F.concat(t["text"], F.lit(END)).alias("body"), (t["role"] == own).alias("mine")))
    views = views.withColumn("segments", segments)
    nothing = F.expr("struct(0L AS at, cast(array() AS array<struct<start:bigint,end:bigint>>) AS spans)")

    def add(done, s):
        start = (done["at"] + F.length(s["head"])).cast("long")
        end = (start + F.length(s["body"])).cast("long")
        more = F.concat(done["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct(end.alias("at"), F.when(s["mine"], more).otherwise(done["spans"]).alias("spans"))

    return views.select(
        F.col("conv").alias(conv_col), "assistant", "part", "piece",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"])), "").alias("text"),
        F.aggregate("segments", nothing, add)["spans"].alias("spans"))
