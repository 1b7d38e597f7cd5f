"""Boundary rows, one per CASE edge (FIXTURES section 3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import d, fmt, raw
from polikit.operators import clean, quality as Q
from polikit.operators.ids import dense_ids
from polikit.operators.lifecycle import to_gold
from polikit.operators.star import dim_date, null_safe_join
from polikit.rules import DEFAULT_RULES as R


def silver_of(spark, rows):
    return clean.to_silver(raw(spark, rows))


def by_id(df, col):
    return {r["object_id"]: r[col] for r in df.select("object_id", col).collect()}


def test_premium_segment_edges(spark):
    vals = ["755.9999", "756", "9640.9999", "9641"]
    s = silver_of(spark, [{"OBJECT_ID": i, "PREMIUM": Decimal(v)} for i, v in enumerate(vals)])
    assert by_id(s, "premium_segment") == {0: "low", 1: "medium", 2: "medium", 3: "high"}


def test_value_segment_edges(spark):
    vals = [None, "0", "-1", "729999.99", "730000", "1999999.99", "2000000"]
    s = silver_of(spark, [{"OBJECT_ID": i, "INSURED_VALUE": None if v is None else Decimal(v)}
                          for i, v in enumerate(vals)])
    assert by_id(s, "value_segment") == {0: "unknown", 1: "unknown", 2: "low", 3: "low", 4: "medium",
                                         5: "medium", 6: "high"}
    iv = by_id(s, "insured_value")
    assert iv[1] is None and iv[2] == Decimal("-1.00")  # exact zero -> null, negatives kept


def test_lifecycle_and_renewal_edges(spark):
    ref = R.reference_date
    rows = [
        {"OBJECT_ID": 1, "INSR_BEGIN": fmt(ref), "INSR_END": fmt(ref + dt.timedelta(days=10))},        # active
        {"OBJECT_ID": 2, "INSR_BEGIN": fmt(ref + dt.timedelta(days=1)), "INSR_END": fmt(ref + dt.timedelta(days=9))},
        {"OBJECT_ID": 3, "INSR_BEGIN": fmt(ref - dt.timedelta(days=300)), "INSR_END": fmt(ref)},          # active
        {"OBJECT_ID": 4, "INSR_BEGIN": fmt(ref - dt.timedelta(days=300)), "INSR_END": fmt(ref - dt.timedelta(days=1))},
        {"OBJECT_ID": 5, "INSR_BEGIN": fmt(ref - dt.timedelta(days=300)), "INSR_END": fmt(ref - dt.timedelta(days=90))},
        {"OBJECT_ID": 6, "INSR_BEGIN": fmt(ref - dt.timedelta(days=300)), "INSR_END": fmt(ref - dt.timedelta(days=91))},
    ]
    g = to_gold(silver_of(spark, rows))
    assert by_id(g, "lifecycle_status") == {1: "active", 2: "future", 3: "active", 4: "expired", 5: "expired",
                                            6: "expired"}
    assert by_id(g, "renewal_candidate") == {1: False, 2: False, 3: False, 4: True, 5: True, 6: False}
    assert by_id(g, "is_active")[3] is True and by_id(g, "is_expired")[4] is True


def test_risk_score_edges(spark):
    rows = [
        {"OBJECT_ID": 1, "PROD_YEAR": 2000},                                  # age 15 -> 0
        {"OBJECT_ID": 2, "PROD_YEAR": 1999},                                  # age 16 -> 1
        {"OBJECT_ID": 3, "PROD_YEAR": None},                                  # age null -> 0
        {"OBJECT_ID": 4, "CLAIM_PAID": Decimal("0")},                         # no claim
        {"OBJECT_ID": 5, "CLAIM_PAID": Decimal("0.01")},                      # claim
        {"OBJECT_ID": 6, "INSURED_VALUE": None, "CLAIM_PAID": Decimal("5"), "PROD_YEAR": 1990},  # 3
    ]
    g = to_gold(silver_of(spark, rows))
    assert by_id(g, "risk_score") == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1, 6: 3}


def test_vehicle_age_may_be_null_or_negative(spark):
    s = silver_of(spark, [{"OBJECT_ID": 1, "PROD_YEAR": None}, {"OBJECT_ID": 2, "PROD_YEAR": 2017}])
    assert by_id(s, "vehicle_age") == {1: None, 2: -2}


def test_parse_dates(spark):
    texts = ["08-AUG-13", "08-Aug-13", "8-AUG-13", "2013-08-08", "", None]
    df = raw(spark, [{"OBJECT_ID": i, "INSR_BEGIN": t} for i, t in enumerate(texts)])
    out = {r["OBJECT_ID"]: r["INSR_BEGIN"] for r in clean.parse_policy_dates(df).collect()}
    assert out == {0: d("2013-08-08"), 1: d("2013-08-08"), 2: None, 3: None, 4: None, 5: None}


def test_cleaning_filters(spark):
    rows = [
        {"OBJECT_ID": 1, "SEX": None}, {"OBJECT_ID": 2, "SEX": 9}, {"OBJECT_ID": 3, "SEX": 2},
        {"OBJECT_ID": 4, "INSR_BEGIN": "N/A"}, {"OBJECT_ID": 5, "INSR_END": None},
        {"OBJECT_ID": 6, "INSR_BEGIN": "02-JAN-15", "INSR_END": "01-JAN-15"},
        {"OBJECT_ID": 7, "PREMIUM": None}, {"OBJECT_ID": 8, "PREMIUM": Decimal("0")},
        {"OBJECT_ID": 9, "INSR_BEGIN": "01-JAN-15", "INSR_END": "01-JAN-15"},
    ]
    s = silver_of(spark, rows)
    assert sorted(r["object_id"] for r in s.collect()) == [3, 9]
    assert by_id(s, "policy_duration_days")[9] == 0
    assert by_id(s, "claim_paid")[3] == Decimal("0.00")


def test_dedup_survivor_is_smallest_row(spark):
    rows = [
        {"OBJECT_ID": 1, "CLAIM_PAID": Decimal("5")}, {"OBJECT_ID": 1, "CLAIM_PAID": Decimal("3")},
        {"OBJECT_ID": 2, "CLAIM_PAID": None, "SEX": 2}, {"OBJECT_ID": 2, "CLAIM_PAID": Decimal("1"), "SEX": 0},
        {"OBJECT_ID": None, "SEX": 1}, {"OBJECT_ID": None, "SEX": 0},
    ]
    s = silver_of(spark, rows)
    got = {r["object_id"]: (r["sex"], r["claim_paid"]) for r in s.collect()}
    assert got == {1: (1, Decimal("3.00")), 2: (0, Decimal("1.00")), None: (0, Decimal("0.00"))}


def test_null_safe_join_matches_nulls(spark):
    keys = list(R.vehicle_attributes)
    full = {"make": "A", "type_vehicle": "T", "ccm_ton": Decimal("1.00"), "seats_num": 2,
            "carrying_capacity": Decimal("3.00"), "usage": "U"}
    rows = [full] + [{**full, k: None} for k in keys] + [{k: None for k in keys}]
    schema = ("make string, type_vehicle string, ccm_ton decimal(18,2), seats_num int, "
              "carrying_capacity decimal(18,2), usage string")
    dim = spark.createDataFrame([tuple(r[k] for k in keys) for r in rows], schema) \
        .withColumn("vehicle_id", F.monotonically_increasing_id())
    fact = spark.createDataFrame([tuple(r[k] for k in keys) for r in rows], schema)
    j = null_safe_join(fact, dim, keys)
    assert j.count() == len(rows)  # every row matches exactly itself
    assert j.select("vehicle_id").distinct().count() == len(rows)


def test_dense_ids(spark):
    df = spark.createDataFrame([(d("2015-01-01"), 2), (d("2015-01-01"), 1), (d("2014-05-05"), 7)], "b date, o int")
    got = [(r["id"], r["b"], r["o"]) for r in dense_ids(df, [F.col("b"), F.col("o")], "id", 3)
           .orderBy("id").collect()]
    assert got == [(1, d("2014-05-05"), 7), (2, d("2015-01-01"), 1), (3, d("2015-01-01"), 2)]
    assert dense_ids(df.limit(0), [F.col("b")], "id").count() == 0


def test_dense_ids_many_partitions_skewed(spark):
    # a third of the rows share one leading key; ids stay 1..N in order
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                  F.col("id").alias("t"))
    out = dense_ids(df, [F.col("k"), F.col("t")], "rid", 7).orderBy("rid").collect()
    assert [r["rid"] for r in out] == list(range(1, 3001))
    assert [(r["k"], r["t"]) for r in out] == sorted((r["k"], r["t"]) for r in out)


def test_calendar(spark):
    cal = {r["full_date"]: r for r in dim_date(spark).collect()}
    assert len(cal) == 3653
    leap = cal[d("2012-02-29")]
    assert (leap["date_id"], leap["quarter"], leap["month_name"], leap["day"]) == (20120229, 1, "February", 29)
    assert cal[d("2011-01-01")]["day_name"] == "Saturday" and cal[d("2011-01-01")]["day_of_week"] == 6
    assert cal[d("2011-01-02")]["day_of_week"] == 0 and cal[d("2011-01-02")]["is_weekend"]
    assert cal[d("2020-12-31")]["is_weekend"] is False


def test_empty_table_findings_pass(spark):
    empty = raw(spark, []).limit(0)
    f = Q.dq_bronze(empty).collect()
    assert f and all(r["pct"] == 0.0 and r["status"] == "PASS" and r["row_count"] == 0 for r in f)


def test_duplicates_count_groups_with_null_keys(spark):
    rows = [{"OBJECT_ID": 1}, {"OBJECT_ID": 1}, {"OBJECT_ID": 1}, {"OBJECT_ID": None}, {"OBJECT_ID": None},
            {"OBJECT_ID": 2}]
    f = Q.run_suite(raw(spark, rows), [Q.duplicates(*R.policy_key)]).collect()[0]
    assert (f["row_count"], f["pct"], f["status"]) == (2, 33.33, "FAIL")


def test_null_operands_pass(spark):
    rows = [{"OBJECT_ID": 1, "PREMIUM": None, "SEX": None, "INSR_END": None}, {"OBJECT_ID": 2}]
    df = raw(spark, rows)
    f = Q.run_suite(df, [Q.positive("PREMIUM"), Q.allowed_values("SEX", [0, 1, 2]),
                         Q.date_order("INSR_BEGIN", "INSR_END", R.date_format)]).collect()
    assert [r["row_count"] for r in f] == [0, 0, 0]
    assert f[1]["issue"] == "value not in [0, 1, 2]"


def test_foreign_key_violation_and_null_child(spark):
    child = spark.createDataFrame([(20210101,), (None,), (20150101,)], "insr_begin_id int")
    cal = dim_date(spark)
    f = Q.foreign_key_findings(child, "fact", [("insr_begin_id", cal, "date_id", "dim_date")],
                               broadcast_parents=("dim_date",)).collect()[0]
    assert (f["row_count"], f["status"], f["pct"]) == (1, "FAIL", 33.33)


def test_preview_limit(spark):
    s = silver_of(spark, [{"OBJECT_ID": i} for i in range(20)])
    assert s.limit(5).count() == 5 and s.limit(15).count() == 15


def test_union_by_name_rejects_drift(spark):
    import pytest
    a = raw(spark, [{"OBJECT_ID": 1}])
    b = raw(spark, [{"OBJECT_ID": 2}]).drop("USAGE")
    with pytest.raises(Exception):
        clean.to_bronze(a, b).collect()
    ok = clean.to_bronze(a, raw(spark, [{"OBJECT_ID": 2}]).select(*reversed(a.columns)))
    assert ok.columns == a.columns and ok.count() == 2


def test_storage_ids_dense_unique_without_shuffle(spark, scratch):
    from polikit.operators.ids import storage_ids
    spark.range(5000).selectExpr("id AS k", "id % 7 AS g").repartition(5).write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t").filter("g <> 3")
    out = storage_ids(t, "rid")
    rows = out.collect()
    assert sorted(r["rid"] for r in rows) == list(range(1, len(rows) + 1))
    assert sorted(r["k"] for r in rows) == sorted(r["k"] for r in t.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan and "rangepartitioning" not in plan


def test_read_csv_explicit_schema_keeps_corrupt_rows(spark, scratch):
    from polikit.sources.files import CORRUPT_COLUMN, read_csv
    from polikit.schemas import RAW_COLUMNS
    good = ",".join(["1", "01-JAN-15", "31-DEC-15", "15", "1201", "100.00", "10.0000", "7", "2010", "4", "1000.00",
                     "Pick-up", "2000.00", "TOYOTA", "Private", ""])
    bad = good.replace("1201", "twelve")
    with open(f"{scratch}/feed.csv", "w") as fh:
        fh.write(",".join(RAW_COLUMNS) + "\n" + good + "\n" + bad + "\n")
    rows = read_csv(spark, f"{scratch}/feed.csv", keep_corrupt=True).collect()
    assert len(rows) == 2
    ok, broken = sorted(rows, key=lambda r: r[CORRUPT_COLUMN] is not None)
    assert ok["INSR_TYPE"] == 1201 and ok["CLAIM_PAID"] is None and ok[CORRUPT_COLUMN] is None
    assert broken["INSR_TYPE"] is None and broken[CORRUPT_COLUMN] == bad


def test_feed_files_read_by_name_whatever_the_order(spark, scratch):
    from conftest import SMOKE
    from polikit.operators.clean import to_bronze
    from polikit.sources.feed import policy_feed_files
    from polikit.sources.files import read_csv, write_csv
    first, second = policy_feed_files(spark, SMOKE)  # second file has its columns reversed
    write_csv(first, f"{scratch}/p1")
    write_csv(second, f"{scratch}/p2")
    assert spark.read.option("header", True).csv(f"{scratch}/p2").columns[0] == "CLAIM_PAID"
    got = to_bronze(read_csv(spark, f"{scratch}/p1"), read_csv(spark, f"{scratch}/p2"))
    want = to_bronze(first, second)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
