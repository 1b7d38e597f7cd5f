"""A large feed made in parts: each row is in one, suites add up, and nothing of a part stays on disk."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from polikit.operators import quality as Q
from polikit.operators.staging import shuffles_dropped, staged_mark
from polikit.plans import layers as L
from polikit.plans import q_quality
from polikit.sources import feed


@pytest.fixture()
def folder(spark, scratch):
    """600 lines with null keys, lines that come twice, and an order key with a third of all lines."""
    rng = random.Random(5)
    day = lambda: dt.datetime(1995, 1, 1) + dt.timedelta(days=rng.randint(0, 900))
    lines = []
    for i in range(600):
        order = 7 if i % 3 == 0 else rng.choice([None, *range(1, 150)])
        lines.append((order, rng.choice([None, *range(1, 30)]), i % 7 + 1, float(rng.randint(1, 50)), rng.randint(1, 9000) / 100,
                      rng.randint(0, 10) / 100, rng.choice("RAN"), rng.choice("FO"), rng.choice([None, day(), day(), day()])))
    lines += lines[:40]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(
        f"{scratch}/lineitem.parquet")
    orders = [(k, rng.choice([None, 1, 2, 3]), float(rng.randint(1, 400_000))) for k in [*range(1, 140), None, None, 9]]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{scratch}/orders.parquet")
    parts = [(k, rng.choice(["ECONOMY X", "PROMO Y"]), f"Brand#{k % 5}", k) for k in range(1, 28)]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_brand string, p_size int").write.parquet(f"{scratch}/part.parquet")
    spark.createDataFrame([(1, "A"), (2, None)], "c_custkey long, c_mktsegment string").write.parquet(f"{scratch}/customer.parquet")
    return scratch


def cut(monkeypatch, rows=0, most=3):
    monkeypatch.setattr(feed, "LEAST_ROWS", rows)
    monkeypatch.setattr(feed, "PART_ROWS", 100)
    monkeypatch.setattr(feed, "MOST_PARTS", most)
    monkeypatch.setattr(feed, "ROWS_PER_PARTITION", 50)


def test_parts_hold_each_row_once(spark, folder, monkeypatch):
    whole = L.bronze(spark, folder)
    assert feed.parts(spark, folder) == [(0, 1)]
    cut(monkeypatch)
    parts = feed.parts(spark, folder)
    assert parts == [(i, 3) for i in range(3)]
    own = [L.bronze(spark, folder, part=p) for p in parts]
    both = own[0]
    for df in own[1:]:
        both = both.unionAll(df)
    assert whole.count() >= 640 and both.exceptAll(whole).count() == 0 and whole.exceptAll(both).count() == 0
    keys = [{r[0] for r in df.select("OBJECT_ID").distinct().collect()} for df in own]
    assert sum(map(len, keys)) == len(set().union(*keys)) and sum(None in k for k in keys) == 1


def test_totals_of_parts_add_up(spark, folder, monkeypatch):
    b = L.bronze(spark, folder)
    want = Q.dq_bronze(b).collect()
    cut(monkeypatch)
    items = Q.bronze_suite(b)
    rows = [Q.suite_totals(L.bronze(spark, folder, part=p), items).first() for p in feed.parts(spark, folder)]
    assert Q.suite_findings(Q.summed_totals(q_quality._frame(spark, rows)), items).collect() == want
    assert {r["status"] for r in want} == {"PASS", "FAIL"} and next(r for r in want if r["check"] == "uniqueness")["row_count"] > 10


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left(spark, before):
    """Shuffle files that stay: they are deleted beside the next step."""
    for _ in range(50):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return found


def test_summary_in_parts_leaves_nothing_on_disk(spark, folder, monkeypatch):
    want = sorted(map(tuple, q_quality.dq_summary(spark, folder).collect()))
    cut(monkeypatch)
    while spark.sparkContext.statusTracker().getActiveStageIds():  # what the first run no longer needs
        time.sleep(0.2)
    before, mark, stages = shuffle_files(spark), staged_mark(), []
    plain = q_quality.stage_table
    monkeypatch.setattr(q_quality, "stage_table", lambda df, name: stages.append((name, left(spark, before))) or plain(df, name))
    kept = set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))
    made = q_quality.dq_summary(spark, folder)
    assert sorted(map(tuple, made.collect())) == want and [n for n, _ in stages] == ["bronze", "silver"] * 3
    assert not any(files for _, files in stages), stages  # what each table's making shuffled is gone before the next is made
    assert staged_mark() == mark and set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))) == kept


def test_the_setting_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true" and spark.range(9).groupBy(F.col("id") % 2).count().count() == 2
        raise ValueError
    assert spark.conf.get(name, None) == was
