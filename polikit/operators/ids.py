"""Dense surrogate keys along a total order, without a single-partition window.

``counted_ids`` numbers rows whose order begins with days: counts by day become offsets, so
rows go to their final place in one shuffle and nothing is sampled or staged. ``dense_ids`` is
for any other order:

``row_number() over (order by k)`` puts every row in one task. Instead:

1. stage the rows, so that range sampling, counting and sorting read files and not the
   plan that made them;
2. range-partition on the order (sampled bounds; a hot leading value is still split,
   because the full order key is unique) into as many partitions as the row count asks
   for, and sort within partitions;
3. in that same stage, record each row's range-partition id and its position in the
   partition as columns, and stage the rows again: ids no longer depend on any later
   re-execution (a lost executor re-reads the staged files instead of re-sampling);
4. count rows per range partition (a one-column scan; one row per partition, so the
   offsets table is bounded by the partition count, not by the data) and take running
   offsets;
5. id = offset(partition) + position + start, via a broadcast join on the partition id.

The order must be total (unique) for the ids to be reproducible; ties are broken by
whatever the sort does, like ``row_number``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import broadcast_if_small, stage_table

_LOW33 = (1 << 33) - 1

#: Rows that one range partition is meant to sort, unless the caller gives a count.
ROWS_PER_PARTITION = 1_000_000
LEAST_ROWS = 50_000


def partitions_for(rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    return max(1, -(-rows // rows_per_partition))


def _located(df: DataFrame) -> DataFrame:
    """``df`` with the partition (_pid) and the place in it (_pos) of each row."""
    return df.select(F.spark_partition_id().alias("_pid"),
                     F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)).alias("_pos"), "*")


def ranged(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted, staged with (_pid, _pos)."""
    src = stage_table(df, "unranked")
    n = num_partitions or partitions_for(src.count())
    return stage_table(_located(src.repartitionByRange(n, *order).sortWithinPartitions(*order)), "ranked")


def _numbered(placed: DataFrame, columns: list[str], id_col: str, start: int, id_type: str) -> DataFrame:
    per = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ident = (F.col("_off") + F.col("_pos") + F.lit(start)).cast(id_type).alias(id_col)
    return placed.join(F.broadcast(offsets), "_pid").select(ident, *[F.col(c) for c in columns])


def dense_ids(df: DataFrame, order: list[Column], id_col: str, num_partitions: int | None = None,
              start: int = 1, id_type: str = "long") -> DataFrame:
    return _numbered(ranged(df, order, num_partitions), df.columns, id_col, start, id_type)


def storage_ids(table: DataFrame, id_col: str, start: int = 1, id_type: str = "long") -> DataFrame:
    """Dense ids 1..N in the order the rows are read, with no shuffle of the rows.

    Partition, place and row are written together, and the counts are taken from what was
    written, so ids are dense and unique however the input is split or re-read. For the row
    order of an unordered ``ROW_NUMBER() OVER ()`` this avoids sorting the whole table."""
    return _numbered(stage_table(_located(table), "located"), table.columns, id_col, start, id_type)


def _day_buckets(rows: DataFrame, per: DataFrame, days: list[str], last: str, size: int) -> DataFrame:
    """``per``: rows (_n), least and greatest ``last`` by day. One row per combination of ``days``: (days, _lo, _width, _p, _from). Rows with at most ``size`` others
    of their days are one bucket; of crowded days, slices of ``last`` of equal width are. _p and _from
    hold each slice's partition and the number of rows before that partition."""
    slices = F.when(F.col("_lo").isNull(), F.lit(1)).otherwise(F.ceil(F.col("_n") / size)).cast("long")
    # (hi - lo) / slices, rounded down, plus one: no slice lies beyond the last
    per = per.withColumn("_slices", slices).withColumn("_width", F.expr("(_hi - _lo) div _slices + 1"))
    crowded = per.filter("_slices > 1")
    counts = per.filter("_slices = 1").select(*days, F.lit(0).cast("long").alias("_slice"), "_n")
    if not crowded.isEmpty():
        keys = [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in days]
        side = broadcast_if_small(crowded.select(*[F.col(d).alias(f"_{d}") for d in days], "_lo", "_width", "_slices"))
        beside = rows.join(side, reduce(lambda a, b: a & b, keys))
        sliced = beside.groupBy(*days, _slice_of(last, F.col("_slices")).alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
        empty = crowded.select(*days, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1)).alias("_slice"),
                               F.lit(0).cast("long").alias("_n"))
        counts = counts.unionByName(sliced.unionByName(empty).groupBy(*days, "_slice").agg(F.sum("_n").alias("_n")))
        counts = stage_table(counts, "day-buckets")
    up_to = Window.unboundedPreceding, -1
    by_day = counts.groupBy(F.col(days[0]).alias("_day")).agg(F.sum("_n").alias("_all"))
    by_day = by_day.select("_day", F.coalesce(F.sum("_all").over(Window.orderBy(F.asc_nulls_last("_day")).rowsBetween(*up_to)),
                                              F.lit(0)).alias("_before"))  # a row a day
    within = Window.partitionBy(days[0]).orderBy(*[F.asc_nulls_last(d) for d in days[1:]], "_slice").rowsBetween(*up_to)
    placed = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    placed = placed.join(by_day, F.col(days[0]).eqNullSafe(F.col("_day")))
    placed = placed.withColumn("_at", F.col("_before") + F.col("_inside")).withColumn("_p", F.floor(F.col("_at") / size).cast("int"))
    starts = placed.groupBy("_p").agg(F.min("_at").alias("_from"))
    placed = placed.join(starts, "_p").groupBy(*days).agg(F.sort_array(F.collect_list(F.struct("_slice", "_p", "_from"))).alias("_s"))
    pair = [F.col(f"_s._{c}").alias(f"_{c}") for c in ("p", "from")]
    joined = placed.join(per.select(*[F.col(d).alias(f"_{d}") for d in days], "_lo", "_width"),
                         reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in days]))
    return stage_table(joined.select(*[f"_{d}" for d in days], "_lo", "_width", *pair), "day-places")


def _slice_of(last: str, slices: Column) -> Column:
    """The slice of a row of crowded days; a row without ``last`` is in the last one."""
    return F.coalesce(F.expr(f"(`{last}` - _lo) div _width"), slices - 1)


def counted_ids(df: DataFrame, days: list[str], last: str, id_col: str, counts_from: DataFrame | None = None,
                rows_per_partition: int | None = None, start: int = 1, id_type: str = "long") -> DataFrame:
    """Dense ids in the order of ``days`` (integers of few different values), then ``last`` (an integer), nulls last.

    Rows are counted by day (partial sums, at most a row a combination of days), the counts
    become offsets, and each row goes to the partition of its day's offset: about
    ``rows_per_partition`` rows each, in order, whatever the days' sizes. A day (with its other
    days) that holds more is cut into slices of ``last``, counted likewise. Sorted within its partition, a row's
    id is the partition's offset plus its place: one shuffle of the rows, no sampling, no
    staging, and a lost partition is numbered alike when it is made again.

    The order must be total. ``counts_from`` may name a narrower table with the same rows. By default
    a small table is dealt over all cores, and a large one by ``ROWS_PER_PARTITION``."""
    narrow = (df if counts_from is None else counts_from).select(*days, F.col(last).cast("long").alias(last))
    per = stage_table(narrow.groupBy(*days).agg(F.count(F.lit(1)).alias("_n"), F.min(last).alias("_lo"), F.max(last).alias("_hi")),
                      "day-counts")
    if rows_per_partition is None:
        total = per.agg(F.sum("_n")).first()[0] or 0
        rows_per_partition = max(LEAST_ROWS, min(ROWS_PER_PARTITION, -(-total // df.sparkSession.sparkContext.defaultParallelism)))
    places = _day_buckets(narrow, per, days, last, rows_per_partition)
    top = places.agg(F.max(F.array_max("_p"))).first()[0]
    beside = df.join(broadcast_if_small(places), reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in days]))
    slice_ = F.when(F.size("_p") == 1, F.lit(0)).otherwise(_slice_of(last, F.size("_p").cast("long"))).cast("int")
    aimed = beside.withColumn("_slice", slice_).select(
        *df.columns, F.col("_p")[F.col("_slice")].alias("_p"), F.col("_from")[F.col("_slice")].alias("_from"))
    lined = aimed.repartitionById((top or 0) + 1, "_p").sortWithinPartitions(*[F.asc_nulls_last(c) for c in (*days, last)])
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))
    ident = F.when(F.spark_partition_id() == F.col("_p"), F.col("_from") + place + start).otherwise(
        F.raise_error(F.lit("rows of another partition")))
    return lined.select(ident.cast(id_type).alias(id_col), *df.columns)
