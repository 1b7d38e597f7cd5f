"""Registered queries: pipeline stages, cleaning steps, KPI tables, star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..operators import clean, kpis
from ..operators.clean import clean_policies, dedup_keep_min, funnel_counts
from ..rules import DEFAULT_RULES as R
from ..sources.feed import policy_feed_files
from . import layers as L
from . import oracle as O
from .registry import register

RAWS = ", ".join(O.RAW)


def _iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"


# -- bronze / union ------------------------------------------------------------

@register("st_bronze", O.with_ctes("bronze", f"SELECT {O.portable(O.RAW)} FROM bronze"))
def st_bronze(spark, sf):
    return L.portable(L.bronze_of_files(spark, sf))


@register("so_union_by_name", O.with_ctes(
    "feed", f"SELECT {O.portable(O.RAW)}, CASE WHEN early THEN 'first' ELSE 'second' END AS source_file FROM feed"))
def so_union_by_name(spark, sf):
    first, second = policy_feed_files(spark, sf)
    u = clean.union_by_name(first.withColumn("source_file", F.lit("first")),
                            second.withColumn("source_file", F.lit("second")))
    return L.portable(u)


# -- cleaning funnel and steps ---------------------------------------------------

@register("mon_clean_funnel", O.with_ctes("deduped", """
SELECT (SELECT count(*) FROM bronze) AS bronze_rows,
       (SELECT count(*) FROM bronze WHERE SEX IN (0, 1, 2)) AS after_sex_filter,
       (SELECT count(*) FROM parsed WHERE INSR_BEGIN IS NOT NULL AND INSR_END IS NOT NULL) AS after_date_parse,
       (SELECT count(*) FROM parsed WHERE INSR_BEGIN IS NOT NULL AND INSR_END IS NOT NULL
                                      AND INSR_END >= INSR_BEGIN) AS after_date_order,
       (SELECT count(*) FROM cleaned) AS after_premium_filter,
       (SELECT count(*) FROM deduped) AS after_dedup"""))
def mon_clean_funnel(spark, sf):
    return funnel_counts(L.bronze(spark, sf))


@register("prj_parse_dates", O.with_ctes("bronze", f"""
SELECT OBJECT_ID AS object_id, INSR_BEGIN AS begin_text,
       {_iso(f"CAST(try_strptime(INSR_BEGIN, {O.FMT}) AS DATE)")} AS begin_date,
       INSR_END AS end_text, {_iso(f"CAST(try_strptime(INSR_END, {O.FMT}) AS DATE)")} AS end_date
FROM bronze"""))
def prj_parse_dates(spark, sf):
    b = L.bronze(spark, sf)
    return L.portable(b.select(
        F.col("OBJECT_ID").alias("object_id"), F.col("INSR_BEGIN").alias("begin_text"),
        parse_date(F.col("INSR_BEGIN"), R.date_format).alias("begin_date"),
        F.col("INSR_END").alias("end_text"), parse_date(F.col("INSR_END"), R.date_format).alias("end_date")))


@register("prj_zero_to_null", O.with_ctes("bronze", """
SELECT OBJECT_ID AS object_id, CAST(INSURED_VALUE AS DOUBLE) AS raw_value,
       CAST(NULLIF(INSURED_VALUE, 0) AS DOUBLE) AS insured_value FROM bronze"""))
def prj_zero_to_null(spark, sf):
    b = L.bronze(spark, sf).select("OBJECT_ID", "INSURED_VALUE", F.col("INSURED_VALUE").alias("raw_value"))
    z = clean.zero_to_null(b, "INSURED_VALUE")
    return L.portable(z.select(F.col("OBJECT_ID").alias("object_id"), "raw_value",
                               F.col("INSURED_VALUE").alias("insured_value")))


@register("prj_fill_claims", O.with_ctes("bronze", """
SELECT OBJECT_ID AS object_id, CAST(CLAIM_PAID AS DOUBLE) AS raw_claim,
       CAST(COALESCE(CLAIM_PAID, 0) AS DOUBLE) AS claim_paid FROM bronze"""))
def prj_fill_claims(spark, sf):
    b = L.bronze(spark, sf).select("OBJECT_ID", "CLAIM_PAID", F.col("CLAIM_PAID").alias("raw_claim"))
    z = clean.fill_zero(b, "CLAIM_PAID")
    return L.portable(z.select(F.col("OBJECT_ID").alias("object_id"), "raw_claim",
                               F.col("CLAIM_PAID").alias("claim_paid")))


@register("ag_dedup_policies", O.with_ctes("deduped", f"""
SELECT {O.portable([c for c in O.RAW if c not in ('INSR_BEGIN', 'INSR_END')])},
       {_iso('INSR_BEGIN')} AS INSR_BEGIN, {_iso('INSR_END')} AS INSR_END FROM deduped"""))
def ag_dedup_policies(spark, sf):
    return L.portable(dedup_keep_min(clean_policies(L.bronze(spark, sf)), R.policy_key))


SILVER_KEY = ["object_id", "insr_begin", "insr_end"]


@register("drv_silver", O.with_ctes("silver", f"""
SELECT object_id, {_iso('insr_begin')} AS insr_begin, {_iso('insr_end')} AS insr_end,
       policy_duration_days, vehicle_age, premium_segment, value_segment FROM silver"""))
def drv_silver(spark, sf):
    return L.portable(L.silver(spark, sf).select(*SILVER_KEY, "policy_duration_days", "vehicle_age",
                                                  "premium_segment", "value_segment"))


@register("st_silver", O.with_ctes("silver", f"SELECT {O.portable(O.SILVER)} FROM silver"))
def st_silver(spark, sf):
    return L.portable(L.silver(spark, sf))


@register("drv_gold", O.with_ctes("gold", f"""
SELECT object_id, {_iso('insr_begin')} AS insr_begin, {_iso('insr_end')} AS insr_end,
       lifecycle_status, is_active, is_expired, renewal_candidate, risk_score FROM gold"""))
def drv_gold(spark, sf):
    return L.portable(L.gold(spark, sf).select(*SILVER_KEY, "lifecycle_status", "is_active", "is_expired",
                                                "renewal_candidate", "risk_score"))


@register("st_gold", O.with_ctes("gold", f"SELECT {O.portable(O.GOLD)} FROM gold"))
def st_gold(spark, sf):
    return L.portable(L.gold(spark, sf))


# -- KPI tables over gold ------------------------------------------------------

def _tally(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _mean(column: str, digits: int, scale: int = 0) -> str:
    return O.rhu(f"sum({column})", f"count({column})", digits, scale)


#: The KPI measures in SQL: tallies of rows that meet a condition, exact sums and means.
MEASURES = {
    "policy_count": "count(*)",
    **{f"{status}_count": _tally(f"lifecycle_status = '{status}'") for status in ("active", "expired", "future")},
    "renewal_candidate_count": _tally("renewal_candidate"),
    "high_risk_count": _tally("risk_score >= 2"),
    **{f"premium_seg_{level}": _tally(f"premium_segment = '{level}'") for level in ("low", "medium", "high")},
    "total_premium": O.rsum("premium", 2), "avg_premium": _mean("premium", 2, 4),
    "total_claim_paid": O.rsum("claim_paid", 2), "avg_claim_paid": _mean("claim_paid", 2, 2),
    "loss_ratio": O.rhu("sum(claim_paid)", "sum(premium)", 4, 2, 4),
    "avg_policy_duration_days": _mean("policy_duration_days", 1),
    "avg_risk_score": _mean("risk_score", 2), "avg_vehicle_age": _mean("vehicle_age", 1),
    "high_risk_pct": O.rhu("100 * " + _tally("risk_score >= 2"), "count(*)", 2),
}


def kpi_select(src: str, group: list[str], measures: list[str]) -> str:
    """SQL of some measures over ``src``, by ``group`` (none: one row)."""
    cols = ", ".join([*group, *[f"{MEASURES[m]} AS {m}" for m in measures]])
    return f"SELECT {cols} FROM {src}" + (f" GROUP BY {', '.join(group)}" if group else "")


@register("kpi_portfolio", O.with_ctes("gold", kpi_select("gold", [], kpis.PORTFOLIO)))
def kpi_portfolio(spark, sf):
    return kpis.portfolio_kpis(L.gold(spark, sf))


@register("kpi_vehicle", O.with_ctes("gold", kpi_select("gold", ["make"], kpis.VEHICLE)))
def kpi_vehicle(spark, sf):
    return kpis.vehicle_kpis(L.gold(spark, sf))


@register("kpi_product", O.with_ctes("gold", kpi_select("gold", ["insr_type"], kpis.PRODUCT)))
def kpi_product(spark, sf):
    return kpis.product_kpis(L.gold(spark, sf))


# -- star schema -------------------------------------------------------------------

@register("dim_vehicle", O.with_ctes("dim_vehicle", f"SELECT vehicle_id, {O.portable(O.VEH)} FROM dim_vehicle"))
def q_dim_vehicle(spark, sf):
    from ..operators.star import dim_vehicle
    return L.portable(dim_vehicle(L.gold(spark, sf)))


@register("dim_insurance_type", O.with_ctes("dim_insurance_type", "SELECT * FROM dim_insurance_type"))
def q_dim_insurance_type(spark, sf):
    from ..operators.star import dim_insurance_type
    return dim_insurance_type(L.gold(spark, sf))


@register("dim_date", O.with_ctes("fact", f"""
SELECT d.date_id, {_iso('d.full_date')} AS full_date, d.year, d.quarter, d.month, d.month_name, d.day, d.day_of_week,
       d.day_name, d.is_weekend, COALESCE(c.n, 0) AS begin_policies
FROM dim_date d LEFT JOIN (SELECT insr_begin_id, count(*) AS n FROM fact GROUP BY insr_begin_id) c
  ON d.date_id = c.insr_begin_id"""))
def q_dim_date(spark, sf):
    """The calendar dimension, each day with the policies beginning on it (reads the tables)."""
    from ..operators.star import calendar_usage
    st = L.star(spark, sf)
    return L.portable(calendar_usage(st["dim_date"], st["fact_policies"]))


FACT_COLS = ["fact_id", "object_id", "vehicle_id", "insurance_type_id", "insr_begin_id", "insr_end_id", "prod_year",
             "sex", "insured_value", "premium", "claim_paid", "policy_duration_days", "vehicle_age", "premium_segment",
             "value_segment", "lifecycle_status", "is_active", "is_expired", "renewal_candidate", "risk_score"]


@register("fact_policies", O.with_ctes("fact", f"SELECT {O.portable(FACT_COLS)} FROM fact"))
def q_fact_policies(spark, sf):
    return L.portable(L.star(spark, sf)["fact_policies"])
