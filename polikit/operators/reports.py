"""KPI views and BI reports over the star schema.

Joins to a dimension go through ``kpis.aggregate_through``: the fact is first reduced
to one row per foreign key (partial aggregation before any shuffle), so the join and
the final group-by work on (#keys) rows, not (#policies). The calendar dimension is
broadcast explicitly (its size is fixed by the calendar range); the vehicle and type
dimensions are left to AQE, which broadcasts them only when their runtime size is
under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import policy as P
from ..functions.money import ratio_half_up
from ..rules import DEFAULT_RULES, PolicyRules
from . import kpis as K

Star = dict[str, DataFrame]


# -- report slicers (FLT-6) ------------------------------------------------------------

def slice_star(star: Star, year: int | None = None, product: str | None = None, risk_score: int | None = None,
               make: str | None = None) -> Star:
    """The star with the fact restricted by the dashboard slicers.

    Attribute filters apply to their (small) dimension, and the fact keeps the rows
    whose key survives, through a left-semi join (no fact columns are added). The year
    slicer becomes a date-key range on the fact itself (pushed to the fact scan), or a
    partition filter when the fact is stored partitioned by ``begin_year``."""
    fact = star["fact_policies"]
    if year is not None and "begin_year" in fact.columns:
        fact = fact.filter(F.col("begin_year") == year)
    elif year is not None:
        fact = fact.filter((F.col("insr_begin_id") >= year * 10000) & (F.col("insr_begin_id") < (year + 1) * 10000))
    if risk_score is not None:
        fact = fact.filter(F.col("risk_score") == risk_score)
    if product is not None:
        ids = star["dim_insurance_type"].filter(F.col("insr_type_name") == product).select("insurance_type_id")
        fact = fact.join(ids, "insurance_type_id", "left_semi")
    if make is not None:
        ids = star["dim_vehicle"].filter(F.col("make") == make).select("vehicle_id")
        fact = fact.join(ids, "vehicle_id", "left_semi")
    return {**star, "fact_policies": fact}


# -- views (AG-2, AG-4, AG-6) ----------------------------------------------------

def vw_portfolio_kpis(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return K.aggregate(star["fact_policies"], [], K.PORTFOLIO, rules)


def vw_vehicle_kpis(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    out = K.aggregate_through(star["fact_policies"], "vehicle_id", star["dim_vehicle"], "vehicle_id",
                              ["make", "type_vehicle"], K.VEHICLE, rules)
    return out.orderBy(F.desc("policy_count"), F.asc_nulls_last("make"), F.asc_nulls_last("type_vehicle"))


def vw_product_kpis(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    out = K.aggregate_through(star["fact_policies"], "insurance_type_id", star["dim_insurance_type"],
                              "insurance_type_id", ["insr_type_name"], K.PRODUCT, rules)
    return out.orderBy(F.desc("policy_count"), "insr_type_name")


# -- the ten BI queries ----------------------------------------------------------

def q01_portfolio(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return vw_portfolio_kpis(star, rules)


def _by_date(star: Star, group: list[str], measures: list[str], rules: PolicyRules) -> DataFrame:
    return K.aggregate_through(star["fact_policies"], "insr_begin_id", star["dim_date"], "date_id", group,
                               measures, rules, broadcast_dim=True)


def q02_by_year(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return _by_date(star, ["year"], ["policy_count", "total_premium", "total_claim_paid", "loss_ratio"],
                    rules).orderBy("year")


def _top_makes(star: Star, measures: list[str], n: int, rules: PolicyRules, where=None,
               count_col: str = "policy_count") -> DataFrame:
    out = K.aggregate_through(star["fact_policies"], "vehicle_id", star["dim_vehicle"], "vehicle_id", ["make"],
                              measures, rules, where=where)
    # Top-k is the feature here; the make tie-break makes the cut deterministic.
    return out.orderBy(F.desc(count_col), F.asc_nulls_last("make")).limit(n)


def q03_top_makes(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return _top_makes(star, ["policy_count", "avg_premium", "loss_ratio", "avg_risk_score"], rules.top_n, rules)


def q04_products(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return vw_product_kpis(star, rules)


def q05_renewals(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return _top_makes(star, ["renewal_candidates", "avg_premium", "avg_risk_score"], rules.top_n, rules,
                      where=F.col("renewal_candidate"), count_col="renewal_candidates")


def q06_risk_distribution(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    counts = star["fact_policies"].groupBy("risk_score").agg(F.count(F.lit(1)).alias("policy_count"))
    # Window over the aggregated rows only (one per risk score: bounded by the score domain).
    counts = counts.withColumn("all_policies", F.sum("policy_count").over(Window.partitionBy()))
    share = ratio_half_up("policy_count * 100", "all_policies", 2)
    return counts.select("risk_score", "policy_count", share.alias("pct")).orderBy("risk_score")


def q07_segment_mix(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    out = K.aggregate_through(star["fact_policies"], "insurance_type_id", star["dim_insurance_type"],
                              "insurance_type_id", ["insr_type_name", "premium_segment"],
                              ["policy_count", "avg_premium"], rules, fact_keys=["premium_segment"])
    return out.orderBy("insr_type_name", "premium_segment")


def q08_monthly(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return _by_date(star, ["year", "month", "month_name"], ["new_policies", "total_premium"],
                    rules).orderBy("year", "month")


def q09_high_risk(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    out = K.aggregate_through(star["fact_policies"], "vehicle_id", star["dim_vehicle"], "vehicle_id",
                              ["type_vehicle"], ["policy_count", "high_risk_count", "high_risk_pct",
                                                 "avg_risk_score"], rules)
    return out.orderBy(F.desc("high_risk_pct"), F.asc_nulls_last("type_vehicle"))


def q10_claim_rate(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    f = star["fact_policies"].withColumn("claim_status", P.claim_status(F.col("claim_paid")))
    return K.aggregate(f, ["claim_status"], ["policy_count", "avg_premium", "avg_claim_paid", "avg_risk_score"],
                       rules).orderBy("claim_status")


# -- dashboard datasets (BI-1 .. BI-8) ----------------------------------------------

def bi_measures(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """Dashboard cards under the dashboard's names, plus active / renewal rate (%)."""
    base = K.aggregate(star["fact_policies"], [], ["policy_count", "active_count", "expired_count",
                                                   "renewal_candidate_count", "total_premium", "total_claim_paid",
                                                   "loss_ratio", "avg_risk_score"], rules)
    return base.select(
        F.col("policy_count").alias("total_policies"), F.col("active_count").alias("active_policies"),
        F.col("expired_count").alias("expired_policies"), F.col("renewal_candidate_count").alias("renewal_candidates"),
        "total_premium", F.col("total_claim_paid").alias("total_claims"), "loss_ratio", "avg_risk_score",
        ratio_half_up("active_count * 100", "policy_count", 2).alias("active_rate_pct"),
        ratio_half_up("renewal_candidate_count * 100", "policy_count", 2).alias("renewal_rate_pct"),
    )


def bi_lifecycle_split(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return K.aggregate(star["fact_policies"], ["lifecycle_status"], ["policy_count"], rules).orderBy("lifecycle_status")


def bi_premium_vs_claims(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return K.aggregate_through(star["fact_policies"], "insurance_type_id", star["dim_insurance_type"],
                               "insurance_type_id", ["insr_type_name"],
                               ["total_premium", "total_claim_paid", "loss_ratio"], rules).orderBy("insr_type_name")


def bi_quarterly(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return _by_date(star, ["year", "quarter"], ["policy_count", "total_premium"], rules).orderBy("year", "quarter")


def bi_risk_by_product(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return K.aggregate_through(star["fact_policies"], "insurance_type_id", star["dim_insurance_type"],
                               "insurance_type_id", ["insr_type_name"],
                               ["policy_count", "high_risk_count", "avg_risk_score"], rules).orderBy("insr_type_name")


def bi_make_scatter(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return K.aggregate_through(star["fact_policies"], "vehicle_id", star["dim_vehicle"], "vehicle_id", ["make"],
                               ["policy_count", "avg_premium", "avg_risk_score"], rules)


def bi_make_detail(star: Star, make: str, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """Drill-through to one make: lifecycle breakdown with its measures."""
    f = slice_star(star, make=make)["fact_policies"]
    return K.aggregate(f, ["lifecycle_status"], ["policy_count", "total_premium", "total_claim_paid",
                                                 "loss_ratio", "avg_risk_score"], rules).orderBy("lifecycle_status")


def bi_top10_makes(star: Star, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return _top_makes(star, ["policy_count", "avg_premium", "loss_ratio", "avg_risk_score"],
                      rules.dashboard_top_n, rules)
