"""A key holding a third of all rows: results stay exact and the plan pre-aggregates."""

from decimal import Decimal

from pyspark.sql import functions as F

from polikit.operators import clean, quality as Q
from polikit.operators.profile import value_counts
from polikit.rules import DEFAULT_RULES as R
from polikit.schemas import RAW_SCHEMA


def _skewed(spark, n=3000):
    ids = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id") + 1000).cast("long").alias("OBJECT_ID"),
        F.col("id"))
    cols = {
        "SEX": F.lit(1), "INSR_BEGIN": F.lit("01-JAN-15"), "INSR_END": F.lit("31-DEC-15"), "EFFECTIVE_YR": F.lit("15"),
        "INSR_TYPE": F.lit(1201), "INSURED_VALUE": F.lit(Decimal("100.00")),
        "PREMIUM": (F.col("id") + 1).cast("decimal(18,4)"), "OBJECT_ID": F.col("OBJECT_ID"), "PROD_YEAR": F.lit(2010),
        "SEATS_NUM": F.lit(4), "CARRYING_CAPACITY": F.lit(Decimal("1.00")), "TYPE_VEHICLE": F.lit("T"),
        "CCM_TON": F.lit(Decimal("1.00")), "MAKE": F.lit("M"), "USAGE": F.lit("U"), "CLAIM_PAID": F.lit(None),
    }
    return ids.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields]).repartition(6)


def test_hot_key_dedup_exact_and_partially_aggregated(spark):
    df = _skewed(spark)
    silver = clean.to_silver(df)
    hot = silver.filter("object_id = 42").collect()
    assert len(hot) == 1 and hot[0]["premium"] == Decimal("1.0000")  # smallest remaining row
    assert silver.count() == 1 + 2000
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side combine before the shuffle on the key


def test_hot_key_is_one_duplicate_group(spark):
    f = Q.run_suite(_skewed(spark), [Q.duplicates(*R.policy_key)]).collect()[0]
    assert f["row_count"] == 1 and f["status"] == "FAIL"


def test_hot_value_counts(spark):
    vc = {r["value"]: r["row_count"] for r in value_counts(_skewed(spark), ["MAKE", "INSURED_VALUE"]).collect()}
    assert vc["M"] == 3000 and vc["100.00"] == 3000


def test_duplicates_survive_colliding_hashes(spark, monkeypatch):
    df = _skewed(spark)
    want = Q.key_duplicates(df, R.policy_key).collect()
    assert tuple(want[0]) == (1, 1000)
    monkeypatch.setattr(Q, "key_hash", lambda keys: [(F.col("OBJECT_ID") % 5).alias("_h1"), F.lit(1).alias("_h2")])
    assert Q.key_duplicates(df, R.policy_key).collect() == want


def test_keys_with_nulls(spark):
    rows = [(None, "a", 1), (None, "a", 2), ("a", None, 3), (None, None, 4), (None, None, 5), (None, None, 6)]
    df = spark.createDataFrame(rows, "x string, y string, z int")
    assert tuple(Q.key_duplicates(df, ["x", "y"]).first()) == (2, 5)
    assert tuple(Q.key_duplicates(df, ["z"]).first()) == (0, 0)
    assert tuple(Q.key_duplicates(df.limit(0), ["x", "y"]).first()) == (0, 0)
