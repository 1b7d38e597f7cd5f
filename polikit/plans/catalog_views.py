"""The star tables and the three KPI views in Spark's catalog, read by SQL text.

Tables are external: the catalog points at written files, and pointing a table at other files is
one change of its location. Views are ``CREATE OR REPLACE VIEW`` with their SQL in the catalog,
so they can be made again over old ones and follow their tables. The fact is reduced to
partial sums by key before it meets a dimension, like ``operators.kpis``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.money import ratio_half_up_sql
from ..operators import kpis
from ..rules import DEFAULT_RULES, PolicyRules


def _tally(condition: str) -> str:
    return f"CAST(count_if({condition}) AS BIGINT)"


def partial_sql(rules: PolicyRules = DEFAULT_RULES) -> dict[str, str]:
    """SQL of the sums and counts that measures are made of, by the names ``kpis.partials`` has."""
    levels = {f"n_seg_{s}": _tally(f"premium_segment = '{s}'") for s in rules.premium_segments}
    values = {"premium": "premium", "claim": "claim_paid", "duration": "policy_duration_days", "risk": "risk_score", "age": "vehicle_age"}
    sums = {f"s_{k}": f"sum({c})" for k, c in values.items()} | {f"c_{k}": f"count({c})" for k, c in values.items()}
    return {"n": "count(1)", "n_active": _tally("is_active"), "n_expired": _tally("is_expired"),
            "n_future": _tally("lifecycle_status = 'future'"), "n_renewal": _tally("renewal_candidate"),
            "n_high_risk": _tally(f"risk_score >= {rules.high_risk_score}")} | levels | sums


#: Measure -> its SQL over the partials' names.
_COUNTS = {"policy_count": "n", "active_count": "n_active", "expired_count": "n_expired", "future_count": "n_future",
           "renewal_candidate_count": "n_renewal", "high_risk_count": "n_high_risk"}
_FINALS = {m: f"CAST({p} AS BIGINT)" for m, p in _COUNTS.items()} | {
    **{f"premium_seg_{s}": f"CAST(n_seg_{s} AS BIGINT)" for s in ("low", "medium", "high")},
    "total_premium": "CAST(round(s_premium, 2) AS DOUBLE)", "total_claim_paid": "CAST(round(s_claim, 2) AS DOUBLE)",
    "avg_premium": ratio_half_up_sql("s_premium", "c_premium", 2, 4), "avg_claim_paid": ratio_half_up_sql("s_claim", "c_claim", 2, 2),
    "loss_ratio": ratio_half_up_sql("s_claim", "s_premium", 4, 2, 4),
    "avg_policy_duration_days": ratio_half_up_sql("s_duration", "c_duration", 1),
    "avg_risk_score": ratio_half_up_sql("s_risk", "c_risk", 2), "avg_vehicle_age": ratio_half_up_sql("s_age", "c_age", 1)}


def view_sql(database: str, measures: list[str], fk: str | None = None, dim: str | None = None, by: tuple[str, ...] = (),
             rules: PolicyRules = DEFAULT_RULES) -> str:
    """SQL of some measures of the fact, by attributes of a dimension (none: one row)."""
    needed = list(dict.fromkeys(p for m in measures for p in kpis.MEASURES[m][0]))
    parts = partial_sql(rules)
    own = ", ".join(f"{parts[p]} AS {p}" for p in needed)
    finals = ", ".join([*by, *[f"{_FINALS[m]} AS {m}" for m in measures]])
    if fk is None:
        return f"SELECT {finals} FROM (SELECT {own} FROM {database}.fact_policies)"
    by_key = f"SELECT {fk}, {own} FROM {database}.fact_policies GROUP BY {fk}"
    rolled = ", ".join([*by, *[f"sum({p}) AS {p}" for p in needed]])
    joined = f"SELECT {rolled} FROM ({by_key}) JOIN {database}.{dim} USING ({fk}) GROUP BY {', '.join(by)}"
    return f"SELECT {finals} FROM ({joined}) ORDER BY policy_count DESC, {', '.join(f'{c} NULLS LAST' for c in by)}"


def views(database: str, rules: PolicyRules = DEFAULT_RULES) -> dict[str, str]:
    """SQL of the three KPI views."""
    return {
        "vw_portfolio_kpis": view_sql(database, kpis.PORTFOLIO, rules=rules),
        "vw_vehicle_kpis": view_sql(database, kpis.VEHICLE, "vehicle_id", "dim_vehicle", ("make", "type_vehicle"), rules),
        "vw_product_kpis": view_sql(database, kpis.PRODUCT, "insurance_type_id", "dim_insurance_type", ("insr_type_name",), rules),
    }


def register_tables(spark: SparkSession, paths: dict[str, str], database: str, location: str | None = None) -> None:
    """Name written Parquet tables in ``database`` (made if need be, in ``location``). A table that is there is pointed at
    its new files."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, path in paths.items():
        full = f"{database}.{name}"
        if spark.catalog.tableExists(full):
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
        else:
            spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")
        spark.catalog.refreshTable(full)


def register_views(spark: SparkSession, database: str, rules: PolicyRules = DEFAULT_RULES) -> list[str]:
    """Create or replace the KPI views; their full names."""
    for name, sql in views(database, rules).items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql}")
    return [f"{database}.{name}" for name in views(database, rules)]
