"""Raw -> bronze -> silver: union of the feed files, cleaning, de-duplication, derivations.

Every step is a lazy ``DataFrame -> DataFrame`` function; the cleaning funnel is
counted with ``funnel_counts`` in one aggregate instead of an action per step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import policy as P
from ..functions.dates import parse_date
from ..rules import DEFAULT_RULES, PolicyRules
from ..schemas import RAW_COLUMNS


# -- bronze -----------------------------------------------------------------

def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a missing or extra column is an error."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def to_bronze(*feed_files: DataFrame) -> DataFrame:
    """The feed files as one bronze table in raw column order."""
    return union_by_name(*feed_files).select(*RAW_COLUMNS)


# -- silver steps -------------------------------------------------------------

def keep_valid_sex(df: DataFrame, domain=DEFAULT_RULES.sex_domain) -> DataFrame:
    """Keep SEX in the domain (a null SEX is dropped too)."""
    return df.filter(F.col("SEX").isin(list(domain)))


def parse_policy_dates(df: DataFrame, fmt: str = DEFAULT_RULES.date_format) -> DataFrame:
    return (df.withColumn("INSR_BEGIN", parse_date(F.col("INSR_BEGIN"), fmt))
              .withColumn("INSR_END", parse_date(F.col("INSR_END"), fmt)))


def keep_dated(df: DataFrame) -> DataFrame:
    return df.filter(F.col("INSR_BEGIN").isNotNull() & F.col("INSR_END").isNotNull())


def keep_ordered_dates(df: DataFrame) -> DataFrame:
    return df.filter(F.col("INSR_END") >= F.col("INSR_BEGIN"))


def keep_positive_premium(df: DataFrame) -> DataFrame:
    return df.filter(F.col("PREMIUM").isNotNull() & (F.col("PREMIUM") > 0))


def zero_to_null(df: DataFrame, column: str = "INSURED_VALUE") -> DataFrame:
    """Exactly 0 means 'not recorded' -> null; every other value (negatives too) is kept."""
    return df.withColumn(column, F.nullif(F.col(column), F.lit(0).cast(df.schema[column].dataType)))


def fill_zero(df: DataFrame, column: str = "CLAIM_PAID") -> DataFrame:
    """No claim filed -> 0."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0).cast(df.schema[column].dataType)))


def dedup_keep_min(df: DataFrame, keys) -> DataFrame:
    """One row per key; the survivor is the smallest remaining row (columns compared
    in order, nulls first), so the result never depends on partitioning.

    Planned as a partial + final aggregation: each map task collapses its rows per key
    before the shuffle, so a hot key (even a third of all rows) ships one row per task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    agg = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
    return agg.select(*[F.col(k) for k in keys], *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def derive_silver_columns(df: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    b, e = F.col("INSR_BEGIN"), F.col("INSR_END")
    return df.select(
        "*",
        F.datediff(e, b).alias("policy_duration_days"),
        (F.year(b) - F.col("PROD_YEAR").cast("int")).alias("vehicle_age"),
        P.premium_segment(F.col("PREMIUM"), rules.premium_cuts).alias("premium_segment"),
        P.value_segment(F.col("INSURED_VALUE"), rules.value_cuts).alias("value_segment"),
    )


# Fixed value: the renaming rule. A column name is stripped, lower-cased, and each blank in it becomes "_".
def snake_case_columns(df: DataFrame) -> DataFrame:
    """Column names by the renaming rule; names that differ only in case or blanks are an error."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("column names that differ only in case or blanks")
    return df.toDF(*names)


def clean_policies(bronze: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """All row filters and value fixes of silver, before de-duplication."""
    return (bronze.transform(keep_valid_sex, rules.sex_domain)
                  .transform(parse_policy_dates, rules.date_format)
                  .transform(keep_dated)
                  .transform(keep_ordered_dates)
                  .transform(keep_positive_premium)
                  .transform(zero_to_null, "INSURED_VALUE")
                  .transform(fill_zero, "CLAIM_PAID"))


def to_silver(bronze: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """Bronze -> silver in the fixed step order; columns snake_case."""
    return (clean_policies(bronze, rules)
            .transform(dedup_keep_min, rules.policy_key)
            .transform(derive_silver_columns, rules)
            .transform(snake_case_columns))


def _step_conditions(rules: PolicyRules) -> dict[str, Column]:
    """Whether a bronze row is left after each row filter of silver."""
    sex_ok = F.col("SEX").isin(list(rules.sex_domain))
    b, e = parse_date(F.col("INSR_BEGIN"), rules.date_format), parse_date(F.col("INSR_END"), rules.date_format)
    dated = sex_ok & b.isNotNull() & e.isNotNull()
    ordered = dated & (e >= b)
    return {"after_sex_filter": sex_ok, "after_date_parse": dated, "after_date_order": ordered,
            "after_premium_filter": ordered & F.col("PREMIUM").isNotNull() & (F.col("PREMIUM") > 0)}


def step_counts(bronze: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """One row: bronze rows and the rows left after each row filter; a task sends one row of counters."""
    return bronze.agg(F.count(F.lit(1)).alias("bronze_rows"),
                      *[F.count_if(ok).alias(name) for name, ok in _step_conditions(rules).items()])


def funnel_of_written(bronze: DataFrame, silver: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """The funnel of written layers: ``step_counts`` of bronze, and the rows of silver, which a
    count of a written Parquet table takes from its files' footers. No key is shuffled, and
    nothing depends on how often a task was tried."""
    left = silver.agg(F.count(F.lit(1)).alias("n")).scalar()
    return step_counts(bronze, rules).select("*", left.alias("after_dedup"))


def funnel_counts(bronze: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """Rows left after each cleaning step, in one job (replaces an action per step).

    One group-by on the policy key (map-side partial aggregation, so a hot key costs
    one row per task) carries the per-step counts; a second, global aggregate sums
    them and counts the keys that keep at least one clean row (= rows after dedup).
    """
    fmt = rules.date_format
    sex_ok = F.col("SEX").isin(list(rules.sex_domain))
    b, e = parse_date(F.col("INSR_BEGIN"), fmt), parse_date(F.col("INSR_END"), fmt)
    dated = sex_ok & b.isNotNull() & e.isNotNull()
    ordered = dated & (e >= b)
    premium_ok = ordered & F.col("PREMIUM").isNotNull() & (F.col("PREMIUM") > 0)
    per_key = bronze.groupBy(F.col("OBJECT_ID"), b.alias("_b"), e.alias("_e")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(sex_ok).alias("n_sex"),
        F.count_if(dated).alias("n_dated"),
        F.count_if(ordered).alias("n_ordered"),
        F.count_if(premium_ok).alias("n_premium"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("bronze_rows"),
        F.coalesce(F.sum("n_sex"), F.lit(0)).cast("long").alias("after_sex_filter"),
        F.coalesce(F.sum("n_dated"), F.lit(0)).cast("long").alias("after_date_parse"),
        F.coalesce(F.sum("n_ordered"), F.lit(0)).cast("long").alias("after_date_order"),
        F.coalesce(F.sum("n_premium"), F.lit(0)).cast("long").alias("after_premium_filter"),
        F.count_if(F.col("n_premium") > 0).alias("after_dedup"),
    )
