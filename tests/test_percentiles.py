"""Percentiles by repeated histograms: exact whatever the values, their skew and their type."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from polikit.operators import profile as P

PROBS = [("min", 0, 100), ("p1", 1, 100), ("p33", 33, 100), ("median", 50, 100), ("p99", 99, 100), ("p99.99", 9999, 10000), ("max", 100, 100)]


def plainly(values, num, den):
    values = sorted(values)
    return values[max(1, -(-len(values) * num // den)) - 1]


def check(spark, columns: dict, kind: str):
    names = list(columns)
    longest = max(map(len, columns.values()))
    rows = [tuple(columns[n][i] if i < len(columns[n]) else None for n in names) for i in range(longest)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {kind}" for n in names)).repartition(5)
    got = {(r["column_name"], r["percentile"]): r["exact_value"] for r in P.percentiles_exact(df, names, PROBS).collect()}
    want = {(n, lbl): plainly([v for v in own if v is not None], num, den)
            for n, own in columns.items() if any(v is not None for v in own) for lbl, num, den in PROBS}
    assert got == want


def test_decimals_of_all_sizes(spark):
    rng = random.Random(1)
    spread = [Decimal(rng.randint(-10 ** 12, 10 ** 12)).scaleb(-4) for _ in range(6000)]
    steep = [Decimal(int(10 ** rng.uniform(0, 13))).scaleb(-4) for _ in range(5000)]
    third = [Decimal("7.5") if rng.random() < 1 / 3 else Decimal(rng.randint(0, 10 ** 9)).scaleb(-4) for _ in range(5000)]
    ends = [Decimal("-9999999999.9999")] + [Decimal("0.0001") * i for i in range(3000)] + [Decimal("9999999999.9999")]
    check(spark, {"spread": spread, "steep": steep, "a third": third, "ends": ends, "one": [Decimal("3.0000")], "none": [None]}, "decimal(18,4)")


def test_long_numbers_that_doubles_cannot_tell_apart(spark):
    rng = random.Random(2)
    near = [Decimal(10 ** 37 + rng.randint(0, 5000)) for _ in range(4000)]
    check(spark, {"near": near}, "decimal(38,0)")
    check(spark, {"longs": [rng.randint(-2 ** 63, 2 ** 63 - 1) for _ in range(3000)], "same": [2 ** 62 + i % 2000 for i in range(5000)]}, "long")


def test_doubles(spark):
    rng = random.Random(3)
    check(spark, {"wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 308) for _ in range(4000)],
                  "edges": [-1.7e308, 1.7e308, 5e-324, 0.0, 1.0] * 400, "ties": [0.1] * 3000 + [0.2]}, "double")
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.0,), (None,)], "x double")
    assert [r["value"] for r in P.percentiles_exact(df, ["x"], [("median", 1, 2)]).collect()] == [2.0]


def test_empty(spark):
    df = spark.createDataFrame([], "a decimal(10,2), b long")
    assert P.percentiles_exact(df, ["a", "b"]).collect() == []


def test_a_pass_shuffles_counters_only(spark):
    """A pass: one scan, task-side sums, no sort and no window; few passes for many rows."""
    n = 200_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 42).otherwise((F.col("id") * 7919) % 1_000_003).cast("decimal(18,4)").alias("x"))
    passes = []
    count = P._count_ranges

    def counted(usable, ranges, kind, floating):
        plan = usable.selectExpr("x AS x").groupBy((F.col("x") % 7).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan
        out = count(usable, ranges, kind, floating)
        passes.append(sum(map(len, out.values())))
        return out
    P._count_ranges = counted
    try:
        got = {r["percentile"]: r["exact_value"] for r in P.percentiles_exact(df, ["x"], PROBS).collect()}
    finally:
        P._count_ranges = count
    values = [42 if i % 3 == 0 else (i * 7919) % 1_000_003 for i in range(n)]
    assert got == {lbl: plainly(values, num, den) for lbl, num, den in PROBS}
    assert len(passes) <= 4 and max(passes) <= len(PROBS) * P.BINS
