"""Registered queries: KPI views, the ten BI queries, dashboard datasets."""

from __future__ import annotations

from ..operators import kpis, reports
from . import layers as L
from . import oracle as O
from .q_layers import kpi_select
from .registry import register

BRAND = "Brand#4"  # drill-through parameter of the make detail page


def _register(key: str, upto: str, sql: str, fn):
    @register(key, O.with_ctes(upto, sql))
    def q(spark, sf):
        return fn(L.star(spark, sf))
    q.__name__ = key
    return q


def _star_q(key: str, sql: str, fn):
    """A report checked against SQL over the star tables."""
    return _register(key, "fact", sql, fn)


def _gold_q(key: str, sql: str, fn):
    """A report checked against SQL over gold itself, without the star: the report's joins and
    ids are then part of what is checked. Policies without a type code are not in the star."""
    return _register(key, "gold", f"SELECT * FROM ({sql.replace('{gold}', GOLD)}) report", fn)


FV = "fact fp JOIN dim_vehicle v ON fp.vehicle_id = v.vehicle_id"
FT = "fact fp JOIN dim_insurance_type i ON fp.insurance_type_id = i.insurance_type_id"
FD = "fact fp JOIN dim_date d ON fp.insr_begin_id = d.date_id"
#: Gold with the names that reports use for a policy's type, begin and claim.
GOLD = """(SELECT *, CASE insr_type WHEN 1201 THEN 'Third party' WHEN 1202 THEN 'Comprehensive' WHEN 1204 THEN 'Other'
                     ELSE 'Unknown' END AS insr_type_name,
          year(insr_begin) AS year, month(insr_begin) AS month, strftime(insr_begin, '%B') AS month_name,
          if(claim_paid > 0, 'With Claim', 'No Claim') AS claim_status
   FROM gold WHERE insr_type IS NOT NULL) g"""

_star_q("vw_portfolio_kpis", kpi_select("fact", [], kpis.PORTFOLIO), reports.vw_portfolio_kpis)
_star_q("vw_vehicle_kpis", kpi_select(FV, ["make", "type_vehicle"], kpis.VEHICLE), reports.vw_vehicle_kpis)
_star_q("vw_product_kpis", kpi_select(FT, ["insr_type_name"], kpis.PRODUCT), reports.vw_product_kpis)
_gold_q("q01_portfolio", kpi_select("{gold}", [], kpis.PORTFOLIO), reports.q01_portfolio)
_gold_q("q02_by_year", kpi_select("{gold}", ["year"], ["policy_count", "total_premium", "total_claim_paid", "loss_ratio"]),
        reports.q02_by_year)
_gold_q("q03_top_makes", kpi_select("{gold}", ["make"], ["policy_count", "avg_premium", "loss_ratio", "avg_risk_score"])
        + " ORDER BY policy_count DESC, make NULLS LAST LIMIT 15", reports.q03_top_makes)
_gold_q("q04_products", kpi_select("{gold}", ["insr_type_name"], kpis.PRODUCT), reports.q04_products)
_gold_q("q05_renewals", f"""
SELECT make, policy_count AS renewal_candidates, avg_premium, avg_risk_score
FROM ({kpi_select("(SELECT * FROM {gold} WHERE renewal_candidate) r", ["make"],
                  ["policy_count", "avg_premium", "avg_risk_score"])}) by_make
ORDER BY policy_count DESC, make NULLS LAST LIMIT 15""", reports.q05_renewals)
_gold_q("q06_risk_distribution", f"""
SELECT risk_score, n AS policy_count, {O.rhu('100 * n', '(SELECT count(*) FROM {gold})', 2)} AS pct
FROM (SELECT risk_score, count(*) AS n FROM {{gold}} GROUP BY ALL) scores""", reports.q06_risk_distribution)
_gold_q("q07_segment_mix", kpi_select("{gold}", ["insr_type_name", "premium_segment"], ["policy_count", "avg_premium"]),
        reports.q07_segment_mix)
_gold_q("q08_monthly", f"""
SELECT year, month, month_name, policy_count AS new_policies, total_premium
FROM ({kpi_select("{gold}", ["year", "month", "month_name"], ["policy_count", "total_premium"])}) months""",
        reports.q08_monthly)
_gold_q("q09_high_risk", kpi_select("{gold}", ["type_vehicle"],
                                    ["policy_count", "high_risk_count", "high_risk_pct", "avg_risk_score"]),
        reports.q09_high_risk)
_gold_q("q10_claim_rate", kpi_select("{gold}", ["claim_status"],
                                     ["policy_count", "avg_premium", "avg_claim_paid", "avg_risk_score"]),
        reports.q10_claim_rate)

_star_q("bi_measures", f"""
SELECT COUNT(*) AS total_policies, CAST(SUM(CAST(is_active AS INTEGER)) AS BIGINT) AS active_policies,
       CAST(SUM(CAST(is_expired AS INTEGER)) AS BIGINT) AS expired_policies,
       CAST(SUM(CAST(renewal_candidate AS INTEGER)) AS BIGINT) AS renewal_candidates,
       {O.rsum('premium', 2)} AS total_premium, {O.rsum('claim_paid', 2)} AS total_claims,
       {O.rhu('SUM(claim_paid)', 'SUM(premium)', 4, 2, 4)} AS loss_ratio,
       {O.rhu('SUM(risk_score)', 'COUNT(risk_score)', 2)} AS avg_risk_score,
       {O.rhu('100 * SUM(CAST(is_active AS INTEGER))', 'COUNT(*)', 2)} AS active_rate_pct,
       {O.rhu('100 * SUM(CAST(renewal_candidate AS INTEGER))', 'COUNT(*)', 2)} AS renewal_rate_pct
FROM fact""", reports.bi_measures)
_star_q("bi_lifecycle_split", "SELECT lifecycle_status, COUNT(*) AS policy_count FROM fact GROUP BY 1",
        reports.bi_lifecycle_split)
_star_q("bi_premium_vs_claims", kpi_select(FT, ["insr_type_name"], ["total_premium", "total_claim_paid", "loss_ratio"]),
        reports.bi_premium_vs_claims)
_star_q("bi_quarterly", kpi_select(FD, ["year", "quarter"], ["policy_count", "total_premium"]), reports.bi_quarterly)
_star_q("bi_risk_by_product", kpi_select(FT, ["insr_type_name"], ["policy_count", "high_risk_count", "avg_risk_score"]),
        reports.bi_risk_by_product)
_star_q("bi_make_scatter", kpi_select(FV, ["make"], ["policy_count", "avg_premium", "avg_risk_score"]),
        reports.bi_make_scatter)
_star_q("bi_make_detail",
        kpi_select(f"{FV} WHERE v.make = '{BRAND}'", ["lifecycle_status"],
                   ["policy_count", "total_premium", "total_claim_paid", "loss_ratio", "avg_risk_score"]),
        lambda s: reports.bi_make_detail(s, BRAND))
_star_q("bi_top10_makes", kpi_select(FV, ["make"], ["policy_count", "avg_premium", "loss_ratio", "avg_risk_score"])
        + " ORDER BY policy_count DESC, make ASC NULLS LAST LIMIT 10", reports.bi_top10_makes)

_star_q("bi_slice_year_product",
        kpi_select(f"{FT} JOIN dim_date d ON fp.insr_begin_id = d.date_id "
                   "WHERE d.year = 2016 AND i.insr_type_name = 'Comprehensive'", [],
                   ["policy_count", "total_premium", "total_claim_paid", "loss_ratio", "avg_risk_score"]),
        lambda s: kpis.aggregate(reports.slice_star(s, year=2016, product="Comprehensive")["fact_policies"], [],
                                 ["policy_count", "total_premium", "total_claim_paid", "loss_ratio",
                                  "avg_risk_score"]))
