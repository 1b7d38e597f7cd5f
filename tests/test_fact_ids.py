"""Ids from counts by day, and the surrogate join: skew, nulls, collisions, plans."""

import random

import pytest
from pyspark.sql import functions as F

from polikit.operators import star
from polikit.operators.ids import counted_ids

SCHEMA = "day int, till int, obj long, note string"


def numbered(spark, rows, size, tasks=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(tasks)
    out = counted_ids(df, ["day", "till"], "obj", "rid", rows_per_partition=size)
    assert out.columns == ["rid", "day", "till", "obj", "note"]
    return out


def last_null(*xs):
    return tuple((x is None, x or 0) for x in xs)


def wanted(rows):
    return [(i + 1, *r) for i, r in enumerate(sorted(rows, key=lambda r: last_null(r[0], r[1], r[2])))]


@pytest.mark.parametrize("size", [3, 50, 10_000])
def test_order_with_a_crowded_day(spark, size):
    """A third of all rows on one day and term; ids of objects far apart; nulls in every column."""
    rng = random.Random(size)
    rows = [(7, 70, o, "hot") for o in rng.sample(range(10 ** 12), 300)]
    rows += [(rng.randint(1, 40), rng.randint(50, 53), o, "x") for o in range(600)]
    rows += [(None, 1, 5, "a"), (3, None, 6, "b"), (None, None, 7, "c"), (7, 70, None, "d")]
    assert [tuple(r) for r in numbered(spark, rows, size).orderBy("rid").collect()] == wanted(rows)


def test_extreme_and_empty(spark):
    rows = [(1, 1, -2 ** 62, "a"), (1, 1, 2 ** 62 - 1, "b"), (1, 1, 0, "c"), (1, 1, 1, "d")]
    assert [r["note"] for r in numbered(spark, rows, 1).orderBy("rid").collect()] == ["a", "c", "d", "b"]
    assert numbered(spark, [], 10).collect() == []


def test_same_ids_whatever_the_partitions_and_aqe(spark):
    rng = random.Random(9)
    rows = [(rng.randint(1, 9), rng.randint(1, 2), o, "") for o in range(400)]
    for tasks, aqe in ((1, "true"), (7, "false"), (3, "true")):
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        try:
            assert [tuple(r) for r in numbered(spark, rows, 20, tasks).orderBy("rid").collect()] == wanted(rows)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_shuffle_of_the_rows(spark, scratch):
    spark.createDataFrame([(i % 5, 1, i, "x" * 20) for i in range(500)], SCHEMA).write.parquet(f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t")
    plan = counted_ids(df, ["day", "till"], "obj", "rid", rows_per_partition=100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1 and "Window" not in plan


ATTRS = ["a", "b", "c"]


def sides(spark, n=900):
    """A vehicle that holds a third of all rows, nulls in every attribute."""
    kinds = [("x", 1, None), ("x", None, 1), (None, 1, 1), (None, None, None), ("x", 1, 1), ("", 0, 0)]
    right = spark.createDataFrame([(*k, i, n // 3 if i == 0 else 1) for i, k in enumerate(kinds)], "a string, b int, c int, vid int, many long")
    rows = [(*kinds[0 if i % 3 == 0 else i % 7 % 6], i) for i in range(n)] + [("absent", 1, 1, -1)]
    return spark.createDataFrame(rows, "a string, b int, c int, obj long").repartition(4), right, {r[3]: kinds.index(r[:3]) for r in rows[:-1]}


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_surrogate_join(spark, broadcast_rows):
    left, right, want = sides(spark)
    out = star.surrogate_join(left, right, ATTRS, "vid", "many", "obj", salt_rows=50, broadcast_rows=broadcast_rows)
    assert out.columns == [*left.columns, "vid"]
    got = [(r["obj"], r["vid"]) for r in out.collect()]
    assert len(got) == len(want) and dict(got) == want


def test_collisions_of_the_surrogate_change_nothing(spark, monkeypatch):
    left, right, want = sides(spark)
    monkeypatch.setattr(star, "surrogate", lambda attrs: F.lit(1).cast("long"))
    for rows in (100, 0):
        got = [(r["obj"], r["vid"]) for r in star.surrogate_join(left, right, ATTRS, "vid", "many", "obj", 50, rows).collect()]
        assert len(got) == len(want) and dict(got) == want


def test_a_crowded_key_is_dealt_over_tasks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    left, right, _ = sides(spark, 3000)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        out = star.surrogate_join(left, right, ATTRS, "vid", "many", "obj", salt_rows=100, broadcast_rows=0)
        tasks = out.filter("vid = 0").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 5 and max(r["count"] for r in tasks) < 500
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_many_vehicles_meet_the_fact_without_a_shuffle(spark, scratch, monkeypatch):
    """Beyond the rows that are broadcast whole, keys and values alone are; colliding keys go the verified way."""
    left, right, want = sides(spark)
    left = left.filter("obj >= 0")

    def joined():
        return star.surrogate_join(left, right, ATTRS, "vid", "many", "obj", salt_rows=50, broadcast_rows=0, lookup_rows=100)

    out = joined()
    assert out.columns == [*left.columns, "vid"]
    got = [(r["obj"], r["vid"]) for r in out.collect()]
    assert len(got) == len(want) and dict(got) == want
    left.write.parquet(f"{scratch}/left")
    left = spark.read.parquet(f"{scratch}/left")
    plan = joined()._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and plan.count("Join") == 1
    monkeypatch.setattr(star, "surrogate", lambda attrs: F.lit(1).cast("long"))
    got = [(r["obj"], r["vid"]) for r in joined().collect()]
    assert len(got) == len(want) and dict(got) == want
