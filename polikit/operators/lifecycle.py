"""Silver -> gold: lifecycle status, flags and risk score (row-local, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import policy as P
from ..rules import DEFAULT_RULES, PolicyRules


def to_gold(silver: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    ref = rules.reference_date
    status = P.lifecycle_status(F.col("insr_begin"), F.col("insr_end"), ref)
    return (silver.withColumn("lifecycle_status", status)
            .withColumn("is_active", F.col("lifecycle_status") == "active")
            .withColumn("is_expired", F.col("lifecycle_status") == "expired")
            .withColumn("renewal_candidate",
                        P.renewal_candidate(F.col("is_expired"), F.col("insr_end"), ref, rules.renewal_window_days))
            .withColumn("risk_score",
                        P.risk_score(F.col("claim_paid"), F.col("insured_value"), F.col("vehicle_age"),
                                     rules.old_vehicle_age)))
