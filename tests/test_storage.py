"""Tables replaced as a whole, catalog views, resumed runs, counts by footers, split input, sketches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from polikit.operators import profile as PF
from polikit.operators import sketches as SK
from polikit.operators.clean import funnel_counts, funnel_of_written, to_bronze, to_silver
from polikit.plans import catalog_views, pipeline
from polikit.plans import layers as L
from polikit.schemas import RAW_COLUMNS
from polikit.sources import files, published
from polikit.sources.feed import policy_feed_files
from test_inputs import LINE, _feed_folder, _write


# -- tables replaced as a whole -----------------------------------------------------------

def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_a_write_that_fails_midway_leaves_the_table(spark, scratch):
    root = f"{scratch}/t"
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, root)
    published.publish(spark.range(10), root)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="midway"):
        published.publish(bad, root)
    assert ids(published.read_published(spark, root)) == list(range(10))
    published.publish(spark.range(20), root)
    assert ids(published.read_published(spark, root)) == list(range(20))
    assert len(published.folders(spark, root, "v-")) == 2  # the remains of the failed write are gone


def test_readers_keep_their_version_and_a_table_may_be_made_from_itself(spark, scratch):
    root = f"{scratch}/t"
    published.publish(spark.range(5), root)
    reader = published.read_published(spark, root)
    published.publish(reader.filter("id > 1"), root)
    assert ids(reader) == [0, 1, 2, 3, 4] and ids(published.read_published(spark, root)) == [2, 3, 4]
    for i in range(3):
        published.publish(spark.range(i), root, keep=1)
    assert len(published.folders(spark, root, "v-")) == 1 and ids(published.read_published(spark, root)) == [0, 1]


def test_partitioned_publication(spark, scratch):
    path = published.publish(spark.range(6).withColumn("k", F.col("id") % 2), f"{scratch}/t", ["k"])
    assert {"k=0", "k=1"} <= set(os.listdir(path))


# -- catalog ------------------------------------------------------------------------------

def test_views_are_made_again_over_old_ones_and_follow_their_tables(spark, scratch):
    star, database = L.star(spark, SMOKE), "views_again"
    n = star["fact_policies"].count()
    for version, keep in (("a", F.col("object_id") % 2 == 0), ("b", F.lit(True))):
        paths = {name: f"{scratch}/{version}/{name}" for name in star}
        for name, path in paths.items():
            files.write_parquet(star[name].filter(keep) if name == "fact_policies" else star[name], path)
        catalog_views.register_tables(spark, paths, database, f"{scratch}/database")
        names = catalog_views.register_views(spark, database)
        count = spark.sql(f"SELECT policy_count FROM {database}.vw_portfolio_kpis").first()[0]
        assert count == n if version == "b" else 0 < count < n
    assert names == [f"{database}.{v}" for v in ("vw_portfolio_kpis", "vw_vehicle_kpis", "vw_product_kpis")]
    for view, fn in (("vw_vehicle_kpis", "vw_vehicle_kpis"), ("vw_product_kpis", "vw_product_kpis"), ("vw_portfolio_kpis", "vw_portfolio_kpis")):
        from polikit.operators import reports
        assert spark.sql(f"SELECT * FROM {database}.{view}").collect() == getattr(reports, fn)(star).collect()
    assert not spark.catalog.listTables(database)[0].isTemporary
    spark.sql(f"DROP DATABASE {database} CASCADE")


# -- runs ---------------------------------------------------------------------------------

def test_a_broken_run_goes_on_behind_its_last_finished_step(spark, scratch, monkeypatch):
    feed, out = list(policy_feed_files(spark, SMOKE)), f"{scratch}/out"

    def broken(*a, **k):
        raise RuntimeError("after silver")
    with monkeypatch.context() as m:
        m.setattr(pipeline, "to_gold", broken)
        with pytest.raises(RuntimeError, match="after silver"):
            pipeline.run_pipeline(spark, feed, out)
    done = json.load(open(f"{out}/_manifest.json"))
    assert set(done) == {"bronze", "dq_bronze", "silver", "dq_silver"}
    made = os.path.getmtime(f"{out}/silver/_SUCCESS")
    res = pipeline.run_pipeline(spark, feed, out, resume=True)
    assert res.skipped == ["bronze", "dq_bronze", "silver", "dq_silver"] and os.path.getmtime(f"{out}/silver/_SUCCESS") == made
    plain = pipeline.run_pipeline(spark, feed, f"{scratch}/plain")
    assert plain.skipped == [] and plain.counts == res.counts
    for name in pipeline.STAR_TABLES:
        a, b = (spark.read.parquet(r.paths[name]) for r in (res, plain))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    again = pipeline.run_pipeline(spark, feed, out, resume=True)
    assert again.skipped == ["bronze", "dq_bronze", "silver", "dq_silver", "gold", "dq_gold", "kpis", "star"]
    assert again.counts == res.counts
    _lost_output_and_options(spark, feed, out)


def _lost_output_and_options(spark, feed, out):
    os.remove(f"{out}/gold/_SUCCESS")
    res = pipeline.run_pipeline(spark, feed, out, resume=True)
    assert res.skipped == ["bronze", "dq_bronze", "silver", "dq_silver"]
    res = pipeline.run_pipeline(spark, feed, out, resume=True, ordered_fact_ids=False)
    assert res.skipped == ["bronze", "dq_bronze", "silver", "dq_silver", "gold", "dq_gold", "kpis"]


def test_changed_input_is_run_anew(spark, scratch):
    li = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    folder, out = _feed_folder(spark, scratch, li), f"{scratch}/out"
    first = pipeline.run_pipeline(spark, list(policy_feed_files(spark, folder)), out)
    _feed_folder(spark, folder, spark.read.parquet(f"{SMOKE}/lineitem.parquet").filter("l_orderkey % 5 = 0"))
    res = pipeline.run_pipeline(spark, list(policy_feed_files(spark, folder)), out, resume=True)
    assert res.skipped == [] and 0 < res.counts["gold"] < first.counts["gold"]


def test_counts_that_a_retry_has_raised_are_counted_anew(spark, scratch):
    files.write_parquet(L.bronze(spark, SMOKE), f"{scratch}/bronze")
    bronze = spark.read.parquet(f"{scratch}/bronze")
    files.write_parquet(to_silver(bronze), f"{scratch}/silver")
    want = funnel_counts(bronze).first().asDict()
    assert funnel_of_written(bronze, spark.read.parquet(f"{scratch}/silver")).first().asDict() == want
    rows = {n: files.footer_rows(spark, f"{scratch}/{n}").agg(F.sum("rows")).first()[0] for n in ("bronze", "silver")}
    assert (rows["bronze"], rows["silver"]) == (want["bronze_rows"], want["after_dedup"])
    true = {"bronze_in" if k == "bronze_rows" else k: v for k, v in want.items()}
    twice = {k: v + 7 for k, v in true.items()}
    for seen in (true, twice, {**true, "after_dedup": 1}, {}):
        assert pipeline.reconciled(seen, bronze, rows["bronze"], rows["silver"]) == true


def test_footers_and_funnel_read_no_key(spark, scratch):
    from test_plans import plan_of
    files.write_parquet(L.bronze(spark, SMOKE), f"{scratch}/bronze")
    bronze = spark.read.parquet(f"{scratch}/bronze")
    assert "hashpartitioning" not in plan_of(spark, funnel_of_written(bronze, bronze))
    assert "ReadSchema: struct<>" in plan_of(spark, files.footer_rows(spark, f"{scratch}/bronze"))


# -- split input --------------------------------------------------------------------------

def test_every_line_is_good_or_rejected(spark, scratch):
    line = LINE | {"CCM_TON": ""}
    rows = [line, line | {"PROD_YEAR": "n/k", "SEX": "x"}, line | {"MAKE": '"A, B"', "OBJECT_ID": "8", "PREMIUM": "?"}, line]
    _write(f"{scratch}/a.csv", RAW_COLUMNS, rows)
    with open(f"{scratch}/a.csv", "a") as fh:
        fh.write("1,2,3\n" + ",".join(["1"] * 20) + "\n")
    _write(f"{scratch}/b.csv", RAW_COLUMNS[::-1], [line | {"OBJECT_ID": "9"}])
    files.split_csv(spark, [f"{scratch}/a.csv", f"{scratch}/b.csv"], f"{scratch}/out")
    good = files.read_split(spark, f"{scratch}/out", "good")
    assert good.columns == RAW_COLUMNS and sorted(r["OBJECT_ID"] for r in good.collect()) == [7, 7, 9]
    rejected = sorted((r["reason"], r["line"], os.path.basename(r["file"])) for r in files.read_split(spark, f"{scratch}/out", "rejected").collect())
    assert [r[0] for r in rejected] == ["does not parse: PREMIUM", "does not parse: SEX, PROD_YEAR", "wrong number of fields", "wrong number of fields"]
    assert {r[2] for r in rejected} == {"a.csv"} and "1,2,3" in [r[1] for r in rejected]
    assert spark.createDataFrame([(rejected[0][1],)], "l string").select(
        F.from_csv("l", F.lit(", ".join(f"`{c}` STRING" for c in RAW_COLUMNS)))["MAKE"]).first()[0] == "A, B"


def test_split_reads_its_input_once(spark, scratch):
    from test_plans import _tasks
    files.write_csv(to_bronze(*policy_feed_files(spark, SMOKE)).coalesce(3), f"{scratch}/raw")
    n = len([f for f in os.listdir(f"{scratch}/raw") if f.startswith("part-")])
    assert _tasks(spark, lambda: files.split_csv(spark, f"{scratch}/raw", f"{scratch}/out")) <= n + 2  # a task looks at the header
    assert spark.read.parquet(f"{scratch}/out").count() == L.bronze(spark, SMOKE).count()


# -- sketches -----------------------------------------------------------------------------

def test_a_new_period_needs_no_old_rows(spark, scratch):
    columns, probs = ["x", "y"], PF.PERCENTILES
    rows = spark.range(60_000).select(
        (F.col("id") % 3).cast("string").alias("p"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.col("id") * 7919, F.lit(100_003)).cast("double")).alias("x"),
        F.lit(None).cast("double").alias("y"))
    parts = [rows.filter(F.col("p") == str(i)) for i in range(3)]
    for part in parts:
        SK.append_sketches(SK.sketch(part, columns, "bronze", F.col("p")), f"{scratch}/s")
    some = SK.merged_percentiles(spark, f"{scratch}/s", probs, "bronze", ["1", "2"])
    checked = SK.rank_check(parts[1].unionByName(parts[2]), some, probs).collect()
    assert len(checked) == len(probs) and all(r["within_bound"] for r in checked)
    everything = SK.merged_percentiles(spark, f"{scratch}/s", probs, "bronze")
    assert all(r["within_bound"] for r in SK.rank_check(rows, everything, probs).collect())
    assert {r["n"] for r in everything.collect()} == {60_000}
    ends = {r["percentile"]: r["value"] for r in everything.collect()}
    assert ends["min"] == rows.agg(F.min("x")).first()[0] and ends["max"] == rows.agg(F.max("x")).first()[0]
    SK.append_sketches(SK.sketch(parts[0].limit(10), columns, "bronze", F.col("p")), f"{scratch}/s")  # replaced, not added
    assert SK.merged_percentiles(spark, f"{scratch}/s", probs, "bronze", ["0"]).first()["n"] == 10
    assert SK.merged_percentiles(spark, f"{scratch}/s", probs, "silver").collect() == []
