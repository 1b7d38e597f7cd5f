"""Approximate percentiles from mergeable sketches kept by layer and period.

A period's rows are sketched once (KLL, one aggregate for all columns) and appended as a few
narrow rows; a report merges the sketches of any layers and periods. A new period file
needs none of the old rows, and a percentile over years reads some kilobytes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a sketch: ranks of merged sketches are within ``RANK_ERROR`` of all rows (99 times in 100, by the sketch's analysis).
SKETCH_SIZE = 4096
RANK_ERROR = 0.002


def sketch(df: DataFrame, columns: list[str], layer: str, period: Column, size: int = SKETCH_SIZE) -> DataFrame:
    """(layer, period, column_name, n, least, greatest, sketch) of ``df``; nulls are left out, a null period is ``unknown``.
    Sketches are combined in each task: a period with a third of all rows is one sketch a task."""
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    aggs = [a for i, v in enumerate(values) for a in (
        F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.kll_sketch_agg_double(v, F.lit(size)).alias(f"s{i}"))]
    per = df.groupBy(F.coalesce(period.cast("string"), F.lit("unknown")).alias("period")).agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"lo{i}").alias("least"),
                        F.col(f"hi{i}").alias("greatest"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return per.select(F.lit(layer).alias("layer"), "period", F.inline(F.array(*entries)))


def append_sketches(sketches: DataFrame, path: str) -> None:
    """Add the sketches of new periods to a table of sketches; a period that is there is replaced."""
    spark = sketches.sparkSession
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sketches.write.mode("overwrite").partitionBy("layer", "period").parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def merged_percentiles(spark: SparkSession, path: str, probs: list[tuple[str, int, int]], layer: str, periods: list[str] | None = None) -> DataFrame:
    """(column_name, percentile, ordinal, n, value) of a layer over some (None: all) periods. The least and greatest
    value are exact; columns without values give no rows."""
    rows = spark.read.parquet(path).filter(F.col("layer") == layer)
    if periods is not None:
        rows = rows.filter(F.col("period").cast("string").isin(periods))
    merged = rows.filter("n > 0").groupBy("column_name").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.kll_merge_agg_double("sketch").alias("sketch"))

    def value(num: int, den: int) -> Column:
        if num in (0, den):
            return F.col("greatest" if num else "least")
        return F.kll_sketch_get_quantile_double("sketch", F.lit(num / den))

    entries = [F.struct(F.lit(lbl).alias("percentile"), F.lit(i).alias("ordinal"), value(num, den).alias("value"))
               for i, (lbl, num, den) in enumerate(probs)]
    return merged.select("column_name", "n", F.inline(F.array(*entries)))


def rank_check(df: DataFrame, percentiles: DataFrame, probs: list[tuple[str, int, int]], error: float = RANK_ERROR) -> DataFrame:
    """(column_name, percentile, ordinal, within_bound): whether the exact rank in ``df`` of each value of ``percentiles`` is within
    ``error`` of all rows of the rank asked for. One pass; only the (columns x percentiles) values pass through the driver."""
    found = percentiles.collect()
    names = sorted({r["column_name"] for r in found})
    aggs = [F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(names)]
    for k, r in enumerate(found):
        x = F.col(f"`{r['column_name']}`").cast("double")
        aggs += [F.count_if(x < r["value"]).alias(f"below{k}"), F.count_if(x <= r["value"]).alias(f"upto{k}")]
    entries = []
    for k, r in enumerate(found):
        n = F.col(f"n{names.index(r['column_name'])}")
        _, num, den = probs[r["ordinal"]]
        asked, slack = n * num / den, n * error + 1
        ok = (F.col(f"below{k}") - slack <= asked) & (asked <= F.col(f"upto{k}") + slack)
        entries.append(F.struct(F.lit(r["column_name"]).alias("column_name"), F.lit(r["percentile"]).alias("percentile"),
                                F.lit(r["ordinal"]).alias("ordinal"), ok.alias("within_bound")))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))
