"""Explicit schemas per layer: nothing is inferred (inference costs a pass and drifts)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PREMIUM = T.DecimalType(18, 4)

# Raw feed / bronze: 16 source columns in feed order.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("SEX", T.IntegerType()),
        T.StructField("INSR_BEGIN", T.StringType()),
        T.StructField("INSR_END", T.StringType()),
        T.StructField("EFFECTIVE_YR", T.StringType()),
        T.StructField("INSR_TYPE", T.IntegerType()),
        T.StructField("INSURED_VALUE", MONEY),
        T.StructField("PREMIUM", PREMIUM),
        T.StructField("OBJECT_ID", T.LongType()),
        T.StructField("PROD_YEAR", T.IntegerType()),
        T.StructField("SEATS_NUM", T.IntegerType()),
        T.StructField("CARRYING_CAPACITY", MONEY),
        T.StructField("TYPE_VEHICLE", T.StringType()),
        T.StructField("CCM_TON", MONEY),
        T.StructField("MAKE", T.StringType()),
        T.StructField("USAGE", T.StringType()),
        T.StructField("CLAIM_PAID", MONEY),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Silver adds these after the (lower-cased) raw columns.
SILVER_DERIVED = ["policy_duration_days", "vehicle_age", "premium_segment", "value_segment"]
SILVER_COLUMNS = [c.lower() for c in RAW_COLUMNS] + SILVER_DERIVED

GOLD_DERIVED = ["lifecycle_status", "is_active", "is_expired", "renewal_candidate", "risk_score"]
GOLD_COLUMNS = SILVER_COLUMNS + GOLD_DERIVED

# One data-quality finding.
FINDING_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("issue", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("pct", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)
FINDING_COLUMNS = [f.name for f in FINDING_SCHEMA.fields]
