"""Business rules of the policy pipeline, passed to every operator as an argument.

No operator hard-codes a threshold: each one takes a ``PolicyRules`` (or the single
value it needs) so a run can be re-parameterised without touching code.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
#   date text format of the raw feed ........ dd-MMM-yy
#   reference ("as of") date ................ 2018-12-31
#   renewal window .......................... 90 days
#   premium segment cuts .................... low < 756 <= medium < 9641 <= high
#   insured-value segment cuts .............. low < 730000 <= medium < 2000000 <= high
#   old vehicle ............................. vehicle_age > 15
#   high risk ............................... risk_score >= 2
#   calendar dimension ...................... 2011-01-01 .. 2020-12-31
#   SEX domain (pipeline) ................... 0, 1, 2
#   SEX domain (EDA profile) ................ 0, 1
#   policy key .............................. OBJECT_ID, INSR_BEGIN, INSR_END
#   insurance type names .................... 1201 Third party, 1202 Comprehensive,
#                                             1204 Other, anything else Unknown
#   lifecycle statuses ...................... active, expired, future
#   risk scores ............................. 0, 1, 2, 3
#   premium segments ........................ low, medium, high
#   value segments .......................... low, medium, high, unknown
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PolicyRules:
    date_format: str = "dd-MMM-yy"
    reference_date: _dt.date = _dt.date(2018, 12, 31)
    renewal_window_days: int = 90
    premium_cuts: tuple[int, int] = (756, 9641)
    value_cuts: tuple[int, int] = (730000, 2000000)
    old_vehicle_age: int = 15
    high_risk_score: int = 2
    calendar_start: _dt.date = _dt.date(2011, 1, 1)
    calendar_end: _dt.date = _dt.date(2020, 12, 31)
    sex_domain: tuple[int, ...] = (0, 1, 2)
    eda_sex_domain: tuple[int, ...] = (0, 1)
    policy_key: tuple[str, ...] = ("OBJECT_ID", "INSR_BEGIN", "INSR_END")
    insr_type_names: tuple[tuple[int, str], ...] = (
        (1201, "Third party"),
        (1202, "Comprehensive"),
        (1204, "Other"),
    )
    unknown_type_name: str = "Unknown"
    lifecycle_domain: tuple[str, ...] = ("active", "expired", "future")
    risk_domain: tuple[int, ...] = (0, 1, 2, 3)
    premium_segments: tuple[str, ...] = ("low", "medium", "high")
    value_segments: tuple[str, ...] = ("low", "medium", "high", "unknown")
    top_n: int = 15
    dashboard_top_n: int = 10
    vehicle_attributes: tuple[str, ...] = field(
        default=("make", "type_vehicle", "ccm_ton", "seats_num", "carrying_capacity", "usage")
    )


DEFAULT_RULES = PolicyRules()
