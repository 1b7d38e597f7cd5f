"""Row-level business expressions of the policy model (all parameterised by rules)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def premium_segment(premium: Column, cuts: tuple[int, int]) -> Column:
    low, high = cuts
    return F.when(premium < low, "low").when(premium < high, "medium").otherwise("high")


def value_segment(insured_value: Column, cuts: tuple[int, int]) -> Column:
    low, high = cuts
    return (F.when(insured_value.isNull(), "unknown").when(insured_value < low, "low")
            .when(insured_value < high, "medium").otherwise("high"))


def lifecycle_status(begin: Column, end: Column, ref: _dt.date) -> Column:
    r = F.lit(ref)
    return F.when(begin > r, "future").when(end < r, "expired").otherwise("active")


def renewal_candidate(is_expired: Column, end: Column, ref: _dt.date, window_days: int) -> Column:
    return is_expired & (F.datediff(F.lit(ref), end) <= window_days)


def risk_score(claim_paid: Column, insured_value: Column, vehicle_age: Column, old_age: int) -> Column:
    return ((claim_paid > 0).cast("int") + insured_value.isNull().cast("int")
            + F.coalesce((vehicle_age > old_age).cast("int"), F.lit(0))).cast("int")


def insr_type_name(code: Column, names: tuple[tuple[int, str], ...], unknown: str) -> Column:
    expr = None
    for k, v in names:
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr.otherwise(unknown)


def claim_status(claim_paid: Column) -> Column:
    return F.when(claim_paid > 0, "With Claim").otherwise("No Claim")
