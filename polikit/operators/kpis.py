"""KPI measures as decomposable partials.

Every measure is a final expression over *partials* (sums and counts). That lets a
report aggregate the fact by its foreign key first (map-side partial aggregation,
one row per key), join the small result to the dimension, and roll the partials up
to the dimension attribute: the join sees one row per key instead of one per policy.
Sums are exact decimals; rounding is exact half-up (see ``functions.money``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import ratio_half_up
from ..rules import DEFAULT_RULES, PolicyRules


def _flag_sum(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def partials(rules: PolicyRules = DEFAULT_RULES) -> dict[str, Callable[[], Column]]:
    """Partial aggregates by name, built on demand (each Column costs JVM round trips)."""
    c = F.col
    return {
        "n": lambda: F.count(F.lit(1)),
        "n_active": lambda: F.sum(c("is_active").cast("int")).cast("long"),
        "n_expired": lambda: F.sum(c("is_expired").cast("int")).cast("long"),
        "n_future": lambda: _flag_sum(c("lifecycle_status") == "future"),
        "n_renewal": lambda: F.sum(c("renewal_candidate").cast("int")).cast("long"),
        "n_high_risk": lambda: _flag_sum(c("risk_score") >= rules.high_risk_score),
        "n_seg_low": lambda: _flag_sum(c("premium_segment") == "low"),
        "n_seg_medium": lambda: _flag_sum(c("premium_segment") == "medium"),
        "n_seg_high": lambda: _flag_sum(c("premium_segment") == "high"),
        "s_premium": lambda: F.sum("premium"), "c_premium": lambda: F.count("premium"),
        "s_claim": lambda: F.sum("claim_paid"), "c_claim": lambda: F.count("claim_paid"),
        "s_duration": lambda: F.sum("policy_duration_days").cast("long"),
        "c_duration": lambda: F.count("policy_duration_days"),
        "s_risk": lambda: F.sum("risk_score").cast("long"), "c_risk": lambda: F.count("risk_score"),
        "s_age": lambda: F.sum("vehicle_age").cast("long"), "c_age": lambda: F.count("vehicle_age"),
    }


# measure -> (partials it needs, final expression from the partials' column names)
Getter = Callable[[str], str]
C = F.col
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[Getter], Column]]] = {
    "policy_count": (("n",), lambda g: C(g("n")).cast("long")),
    "active_count": (("n_active",), lambda g: C(g("n_active")).cast("long")),
    "expired_count": (("n_expired",), lambda g: C(g("n_expired")).cast("long")),
    "future_count": (("n_future",), lambda g: C(g("n_future")).cast("long")),
    "renewal_candidate_count": (("n_renewal",), lambda g: C(g("n_renewal")).cast("long")),
    "renewal_candidates": (("n",), lambda g: C(g("n")).cast("long")),
    "new_policies": (("n",), lambda g: C(g("n")).cast("long")),
    "high_risk_count": (("n_high_risk",), lambda g: C(g("n_high_risk")).cast("long")),
    "premium_seg_low": (("n_seg_low",), lambda g: C(g("n_seg_low")).cast("long")),
    "premium_seg_medium": (("n_seg_medium",), lambda g: C(g("n_seg_medium")).cast("long")),
    "premium_seg_high": (("n_seg_high",), lambda g: C(g("n_seg_high")).cast("long")),
    "total_premium": (("s_premium",), lambda g: F.round(C(g("s_premium")), 2).cast("double")),
    "avg_premium": (("s_premium", "c_premium"), lambda g: ratio_half_up(g("s_premium"), g("c_premium"), 2, 4)),
    "total_claim_paid": (("s_claim",), lambda g: F.round(C(g("s_claim")), 2).cast("double")),
    "avg_claim_paid": (("s_claim", "c_claim"), lambda g: ratio_half_up(g("s_claim"), g("c_claim"), 2, 2)),
    "loss_ratio": (("s_claim", "s_premium"), lambda g: ratio_half_up(g("s_claim"), g("s_premium"), 4, 2, 4)),
    "avg_policy_duration_days": (("s_duration", "c_duration"),
                                 lambda g: ratio_half_up(g("s_duration"), g("c_duration"), 1)),
    "avg_risk_score": (("s_risk", "c_risk"), lambda g: ratio_half_up(g("s_risk"), g("c_risk"), 2)),
    "avg_vehicle_age": (("s_age", "c_age"), lambda g: ratio_half_up(g("s_age"), g("c_age"), 1)),
    "high_risk_pct": (("n_high_risk", "n"), lambda g: ratio_half_up(f"{g('n_high_risk')} * 100", g("n"), 2)),
}

PORTFOLIO = ["policy_count", "active_count", "expired_count", "future_count", "renewal_candidate_count",
             "total_premium", "avg_premium", "total_claim_paid", "avg_claim_paid", "loss_ratio",
             "avg_policy_duration_days", "avg_risk_score", "high_risk_count"]
VEHICLE = ["policy_count", "active_count", "avg_vehicle_age", "total_premium", "avg_premium", "total_claim_paid",
           "avg_claim_paid", "loss_ratio", "avg_risk_score"]
PRODUCT = ["policy_count", "active_count", "expired_count", "renewal_candidate_count", "total_premium",
           "avg_premium", "total_claim_paid", "avg_claim_paid", "loss_ratio", "avg_policy_duration_days",
           "premium_seg_low", "premium_seg_medium", "premium_seg_high"]


def _needed(measures) -> list[str]:
    out: list[str] = []
    for m in measures:
        for p in MEASURES[m][0]:
            if p not in out:
                out.append(p)
    return out


def _finals(measures, getter: Getter) -> list[Column]:
    return [MEASURES[m][1](getter).alias(m) for m in measures]


def aggregate(df: DataFrame, keys: list, measures: list[str], rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """Group ``df`` (gold or fact rows) by ``keys`` (empty: one row) and compute ``measures``."""
    parts = partials(rules)
    need = _needed(measures)
    pre = df.groupBy(*keys).agg(*[parts[p]().alias(p) for p in need])
    return pre.select(*keys, *_finals(measures, str))


def aggregate_through(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str, group_cols: list[str],
                      measures: list[str], rules: PolicyRules = DEFAULT_RULES, fact_keys: list[str] | None = None,
                      broadcast_dim: bool = False, where: Column | None = None) -> DataFrame:
    """fact JOIN dim ON fk = dim_key, GROUP BY group_cols — with the fact pre-aggregated
    by (fk, *fact_keys) before the join (eager aggregation)."""
    parts = partials(rules)
    need = _needed(measures)
    fact_keys = list(fact_keys or [])
    src = fact if where is None else fact.filter(where)
    pre = src.groupBy(fk, *fact_keys).agg(*[parts[p]().alias(p) for p in need])
    d = dim.select(F.col(dim_key).alias("_dk"), *[c for c in group_cols if c not in fact_keys])
    if broadcast_dim:
        d = F.broadcast(d)
    joined = pre.join(d, pre[fk] == d["_dk"], "inner")
    rolled = joined.groupBy(*group_cols).agg(*[F.sum(p).alias(p) for p in need])
    return rolled.select(*group_cols, *_finals(measures, str))


def portfolio_kpis(gold: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return aggregate(gold, [], PORTFOLIO, rules)


def vehicle_kpis(gold: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return aggregate(gold, ["make"], VEHICLE, rules)


def product_kpis(gold: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return aggregate(gold, ["insr_type"], PRODUCT, rules)
