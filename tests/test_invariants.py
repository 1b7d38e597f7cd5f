"""Invariants of the layers and the star schema (sf0.001 driver tables)."""

from pyspark.sql import functions as F

from conftest import SMOKE
from polikit.operators import kpis
from polikit.plans import layers as L


def test_layer_invariants(spark):
    gold = L.gold(spark, SMOKE).cache()
    n = gold.count()
    p = kpis.portfolio_kpis(gold).collect()[0]
    assert p["policy_count"] == n > 0
    assert p["active_count"] + p["expired_count"] + p["future_count"] == n
    prod = kpis.product_kpis(gold).collect()
    assert sum(r["policy_count"] for r in prod) == n
    for r in prod:
        assert r["premium_seg_low"] + r["premium_seg_medium"] + r["premium_seg_high"] == r["policy_count"]
    assert gold.groupBy("object_id", "insr_begin", "insr_end").count().filter("count > 1").count() == 0
    gold.unpersist()


def test_star_invariants(spark):
    st = L.star(spark, SMOKE)
    fact, gold = st["fact_policies"], L.gold(spark, SMOKE)
    n = fact.count()
    assert n == gold.filter(F.col("insr_type").isNotNull()).count()
    ids = fact.agg(F.min("fact_id"), F.max("fact_id"), F.countDistinct("fact_id")).collect()[0]
    assert tuple(ids) == (1, n, n)
    v = st["dim_vehicle"].agg(F.min("vehicle_id"), F.max("vehicle_id"), F.count(F.lit(1))).collect()[0]
    assert v[0] == 1 and v[1] == v[2]
    for fk, dim, pk in (("vehicle_id", "dim_vehicle", "vehicle_id"),
                        ("insurance_type_id", "dim_insurance_type", "insurance_type_id"),
                        ("insr_begin_id", "dim_date", "date_id"), ("insr_end_id", "dim_date", "date_id")):
        assert fact.join(st[dim], fact[fk] == st[dim][pk], "left_anti").count() == 0
