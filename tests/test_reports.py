"""Report semantics beyond the oracle: slicers against brute-force filters, and the
pipeline's written star giving the same reports as the registered queries."""

from pyspark.sql import functions as F

from conftest import SMOKE
from polikit.operators import kpis, reports
from polikit.plans import layers as L


def _joined(star):
    f, v, t = star["fact_policies"], star["dim_vehicle"], star["dim_insurance_type"]
    return (f.join(v.select("vehicle_id", "make"), "vehicle_id")
             .join(t.select("insurance_type_id", "insr_type_name"), "insurance_type_id")
             .withColumn("year", (F.col("insr_begin_id") / 10000).cast("int")))


def test_slicers_match_brute_force(spark):
    star = L.star(spark, SMOKE)
    j = _joined(star)
    make = j.groupBy("make").count().orderBy(F.desc("count"), "make").first()["make"]
    cases = [dict(year=2016), dict(product="Comprehensive"), dict(risk_score=1), dict(make=make),
             dict(year=2015, product="Third party", make=make)]
    for c in cases:
        sliced = reports.slice_star(star, **c)["fact_policies"].select("fact_id")
        brute = j
        if "year" in c:
            brute = brute.filter(F.col("year") == c["year"])
        if "product" in c:
            brute = brute.filter(F.col("insr_type_name") == c["product"])
        if "risk_score" in c:
            brute = brute.filter(F.col("risk_score") == c["risk_score"])
        if "make" in c:
            brute = brute.filter(F.col("make") == c["make"])
        got = sorted(r[0] for r in sliced.collect())
        assert got == sorted(r[0] for r in brute.select("fact_id").collect()), c
        assert got or c.get("year") == 2015


def test_written_star_gives_same_reports(spark, scratch):
    star = L.star(spark, SMOKE)
    written = {}
    for name, df in star.items():
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        written[name] = spark.read.parquet(f"{scratch}/{name}")
    for fn in (reports.q02_by_year, reports.q03_top_makes, reports.q07_segment_mix, reports.q09_high_risk,
               reports.vw_product_kpis, reports.bi_quarterly):
        assert fn(star).collect() == fn(written).collect(), fn.__name__


def test_eager_aggregation_equals_join_then_group(spark):
    star = L.star(spark, SMOKE)
    eager = reports.vw_vehicle_kpis(star)
    j = star["fact_policies"].join(star["dim_vehicle"].select("vehicle_id", "make", "type_vehicle"), "vehicle_id")
    plain = kpis.aggregate(j, ["make", "type_vehicle"], kpis.VEHICLE)
    key = ["make", "type_vehicle"]
    assert sorted(map(tuple, eager.collect()), key=str) == sorted(map(tuple, plain.select(*key, *kpis.VEHICLE)
                                                                     .collect()), key=str)


def _sorted_by(rows, *keys):
    """Whether rows are in order of the keys; '-x' is descending, nulls last."""
    def key(r):
        out = []
        for k in keys:
            v = r[k.lstrip("-")]
            out.append((v is None, 0 if v is None else (-v if k[0] == "-" else v)))
        return out
    return [key(r) for r in rows] == sorted(key(r) for r in rows)


def test_report_order(spark):
    star = L.star(spark, SMOKE)
    orders = {
        reports.vw_vehicle_kpis: ("-policy_count", "make", "type_vehicle"),
        reports.vw_product_kpis: ("-policy_count", "insr_type_name"),
        reports.q02_by_year: ("year",), reports.q03_top_makes: ("-policy_count", "make"),
        reports.q04_products: ("-policy_count", "insr_type_name"),
        reports.q05_renewals: ("-renewal_candidates", "make"), reports.q06_risk_distribution: ("risk_score",),
        reports.q07_segment_mix: ("insr_type_name", "premium_segment"), reports.q08_monthly: ("year", "month"),
        reports.q09_high_risk: ("-high_risk_pct",), reports.q10_claim_rate: ("claim_status",),
        reports.bi_top10_makes: ("-policy_count", "make"),
    }
    for fn, keys in orders.items():
        rows = fn(star).collect()
        assert rows and _sorted_by(rows, *keys), fn.__name__
