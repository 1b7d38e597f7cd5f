"""Plan shape of every registered query: no cartesian / nested-loop joins, no Python
UDFs, Parquet scans pruned to the columns they need."""

import re

import pytest

from conftest import SMOKE

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def plan_of(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _keys():
    from polikit.plans import catalog
    return sorted(catalog.QUERIES)


@pytest.mark.parametrize("key", _keys())
def test_plan_shape(spark, built, key):
    df = built(key)
    plan = plan_of(spark, df)
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad} in plan"
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        if "lineitem" in plan and "l_comment" in schema:
            pytest.fail(f"{key}: unpruned lineitem scan")


def test_feed_scan_pruned_and_pushed(spark):
    from polikit.plans import layers as L
    plan = plan_of(spark, L.bronze_of_files(spark, SMOKE))
    assert "LessThan(l_shipdate" in plan and "GreaterThanOrEqual(l_shipdate" in plan
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "l_suppkey" not in schema and "l_tax" not in schema and "o_orderpriority" not in schema


def test_dedup_is_partially_aggregated(spark):
    from polikit.plans import layers as L
    plan = plan_of(spark, L.silver(spark, SMOKE))
    # map-side (partial) aggregation below the shuffle: a hot key ships one row per task
    assert plan.count("SortAggregate") + plan.count("HashAggregate") >= 2
    assert "Window" not in plan


def _written_star(spark, scratch):
    from polikit.plans import layers as L
    out = {}
    for name, df in L.star(spark, SMOKE).items():
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        out[name] = spark.read.parquet(f"{scratch}/{name}")
    return out


def test_reports_aggregate_fact_before_join(spark, scratch):
    from polikit.operators import reports
    plan = plan_of(spark, reports.q03_top_makes(_written_star(spark, scratch)))
    tree = plan.split("\n\n")[0]
    # fact scan -> partial/final aggregate keyed by vehicle_id -> join -> aggregate by make
    assert re.search(r"HashAggregate.*\n(.*\n)*?Keys \[1\]: \[vehicle_id", plan)
    join_line = next(i for i, l in enumerate(tree.splitlines()) if "Join" in l)
    assert any("HashAggregate" in l for l in tree.splitlines()[join_line + 1:])
    assert re.search(r"Keys \[1\]: \[make", plan)


def test_calendar_is_broadcast(spark, scratch):
    from polikit.operators import reports
    plan = plan_of(spark, reports.q02_by_year(_written_star(spark, scratch)))
    assert "BroadcastExchange" in plan and "BroadcastHashJoin" in plan


def _hashed_exchanges(plan: str) -> list[list[str]]:
    """Names of the columns that each hash exchange of a formatted plan moves."""
    found = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]\s*\nArguments: hashpartitioning", plan)
    return [[re.sub(r"#.*", "", c.strip()) for c in cols.split(",")] for cols in found]


def test_no_check_column_crosses_an_exchange(spark, scratch):
    """Row checks are one global aggregate; duplicates move a hash of the key and, for those seen
    twice, the key."""
    from polikit.operators import quality
    from polikit.plans import layers as L
    from polikit.rules import DEFAULT_RULES as R
    L.bronze(spark, SMOKE).write.parquet(f"{scratch}/bronze")
    bronze = spark.read.parquet(f"{scratch}/bronze")
    for df in (quality.dq_bronze(bronze), quality.eda_findings(bronze)):
        plan = plan_of(spark, df)
        moved = _hashed_exchanges(plan)
        assert moved and {c for cols in moved for c in cols} <= {"_h1", "_h2", "count", *R.policy_key}
        assert "Window" not in plan
    assert "hashpartitioning" not in plan_of(spark, quality.run_suite(bronze, quality.nulls(bronze)))


def _tasks(spark, action) -> int:
    """Tasks that the action's jobs ran."""
    sc = spark.sparkContext
    group = f"tasks-{id(action)}"
    sc.setJobGroup(group, "count tasks")
    try:
        action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
    return sum(info.numTasks for info in map(status.getStageInfo, stages) if info)


def test_small_dimension_does_not_start_a_task_a_shuffle_partition(spark, scratch):
    from polikit.operators.star import dim_insurance_type, dim_vehicle
    from polikit.plans import layers as L
    L.gold(spark, SMOKE).write.parquet(f"{scratch}/gold")
    gold = spark.read.parquet(f"{scratch}/gold")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert _tasks(spark, lambda: dim_insurance_type(gold).collect()) < 64
        placed = []
        from polikit.operators import ids
        keep = ids._numbered
        ids._numbered = lambda df, *a: placed.append(df) or keep(df, *a)
        try:
            dim_vehicle(gold).collect()
        finally:
            ids._numbered = keep
        assert placed[0].select("_pid").distinct().count() == 1  # by rows, not by shuffle partitions
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _tree(spark, df):
    return plan_of(spark, df).split("\n\n")[0]


def test_no_single_partition_on_policy_rows(spark, scratch):
    """One-task exchanges hold counts, targets or finished groups, never policy rows."""
    from polikit.operators import profile
    from polikit.plans import layers as L
    L.silver(spark, SMOKE).write.parquet(f"{scratch}/silver")
    silver = spark.read.parquet(f"{scratch}/silver")
    for df in (profile.quantile_segments(silver), L.silver(spark, SMOKE), L.gold(spark, SMOKE)):
        assert "SinglePartition" not in _tree(spark, df)


def test_joins_without_broadcasts_are_sort_merge_joins(spark, scratch):
    from polikit.operators.star import build_star
    from polikit.plans import layers as L
    L.gold(spark, SMOKE).write.parquet(f"{scratch}/gold")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feed = _tree(spark, L.bronze(spark, SMOKE))
        assert feed.count("SortMergeJoin") == 3 and "NestedLoop" not in feed and "Broadcast" not in feed
        star = build_star(spark.read.parquet(f"{scratch}/gold"))
        assert star["fact_policies"].count() > 0
        assert "NestedLoop" not in _tree(spark, star["fact_policies"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_silver_groups_where_the_feed_was_joined(spark, monkeypatch):
    """Without broadcasts the policy key needs no shuffle behind the feed's joins; a large feed is dealt by its rows."""
    from polikit.plans import layers as L
    from polikit.sources import feed
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    want = sorted(map(str, L.silver(spark, SMOKE).collect()))
    try:
        for k, v in zip(before, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        monkeypatch.setattr(feed, "LEAST_ROWS", 0)
        monkeypatch.setattr(feed, "ROWS_PER_PARTITION", 50)
        df = L.silver(spark, SMOKE)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(") == 6 and "l_orderkey" in plan  # two a join, none for the key
        n = -(-spark.read.parquet(f"{SMOKE}/lineitem.parquet").count() // 50)
        assert df.rdd.getNumPartitions() == n and sorted(map(str, df.collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", ["dq_silver", "dq_summary"])
def test_suites_read_written_layers(built, key):
    """The joins of the feed are not made again for each pass of a suite."""
    plan = built(key)._jdf.queryExecution().analyzed().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan
