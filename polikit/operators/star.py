"""Star schema: vehicle / insurance-type / date dimensions and the policy fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import policy as P
from ..functions.dates import date_key
from ..rules import DEFAULT_RULES, PolicyRules
from ..sources.calendar import dim_date as _calendar_dim
from .ids import counted_ids, dense_ids, storage_ids
from .staging import BROADCAST_ROWS, broadcast_if_small, stage_table

FACT_MEASURE_COLUMNS = [
    ("prod_year", "int"), ("sex", "int"), ("insured_value", None), ("premium", None), ("claim_paid", None),
    ("policy_duration_days", "int"), ("vehicle_age", "int"), ("premium_segment", None), ("value_segment", None),
    ("lifecycle_status", None), ("is_active", None), ("is_expired", None), ("renewal_candidate", None),
    ("risk_score", "int"),
]


#: Policies of one vehicle that a join task is meant to take.
SALT_ROWS = 1_000_000
#: Vehicles of which a table of key and id alone (some 40 bytes a row) is broadcast.
LOOKUP_ROWS = 2_000_000


def counted_vehicles(gold: DataFrame, rules: PolicyRules = DEFAULT_RULES, num_partitions: int | None = None) -> DataFrame:
    """``dim_vehicle`` with the policies of each combination (``_policies``), from the same aggregate."""
    attrs = list(rules.vehicle_attributes)
    counted = gold.groupBy(*attrs).agg(F.count(F.lit(1)).alias("_policies"))
    return dense_ids(counted, [F.col(a).asc_nulls_last() for a in attrs], "vehicle_id", num_partitions, id_type="int")


def dim_vehicle(gold: DataFrame, rules: PolicyRules = DEFAULT_RULES, num_partitions: int | None = None) -> DataFrame:
    """Distinct vehicle attribute combinations with a dense id in attribute order (nulls last)."""
    attrs = list(rules.vehicle_attributes)
    distinct = gold.select(*attrs).distinct()
    return dense_ids(distinct, [F.col(a).asc_nulls_last() for a in attrs], "vehicle_id", num_partitions, id_type="int")


def dim_insurance_type(gold: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """One row per type code. The codes are a fixed code list (a handful), so a plain window
    over the distinct codes numbers them; no range partitioning."""
    codes = gold.select(F.col("insr_type").alias("insr_type_code")).distinct()
    number = F.row_number().over(Window.orderBy(F.col("insr_type_code").asc_nulls_last()))
    return codes.select(number.alias("insurance_type_id"), "insr_type_code",
                        P.insr_type_name(F.col("insr_type_code"), rules.insr_type_names,
                                         rules.unknown_type_name).alias("insr_type_name"))


def dim_date(spark: SparkSession, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return _calendar_dim(spark, rules.calendar_start, rules.calendar_end)


def calendar_usage(calendar: DataFrame, fact: DataFrame, key: str = "insr_begin_id",
                   out: str = "begin_policies") -> DataFrame:
    """Every calendar day with the number of fact rows whose ``key`` is that day (0 if
    none). The fact is reduced to one row per day before the join (partial aggregation),
    so the join sees at most one row per calendar day on each side."""
    per_day = fact.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    j = calendar.join(per_day, calendar["date_id"] == per_day[key], "left")
    return j.select(*[calendar[c] for c in calendar.columns], F.coalesce(per_day[out], F.lit(0)).alias(out))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` with IS NOT DISTINCT FROM; right key columns dropped.

    Catalyst plans ``<=>`` conjunctions as a hash/sort-merge join on
    (coalesce(k), isnull(k)) pairs, not a nested loop.
    """
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])
    return left.join(right, cond, "inner").drop(*[right[k] for k in keys])


def surrogate(attrs: list[str]) -> Column:
    """A 64-bit key of null-safe attributes: of the values and of which are null."""
    nulls = reduce(lambda a, b: a + b, [F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(attrs)])
    return F.xxhash64(*attrs, nulls)


def surrogate_join(left: DataFrame, right: DataFrame, attrs: list[str], value: str, count: str | None = None,
                   salt: str | None = None, salt_rows: int = SALT_ROWS, broadcast_rows: int = BROADCAST_ROWS,
                   lookup_rows: int = 0) -> DataFrame:
    """``left`` with ``value`` of the row of ``right`` that has the same ``attrs`` (nulls equal), inner.

    The join key is one long instead of the attributes (six columns and their null flags would be
    hashed, shuffled and compared); matches are verified on the attributes, so a collision of
    keys costs a comparison and changes nothing. A ``right`` of at most ``broadcast_rows`` is broadcast.
    One of at most ``lookup_rows`` is broadcast as key and value alone, where no two of its rows share a
    key; that needs a ``right`` that has the attributes of every row of ``left`` (then a key stands for
    one combination on either side, and nothing is left to verify). Else a row of ``right`` whose ``count`` exceeds ``salt_rows`` is repeated once for each so many, and the
    rows of ``left`` are dealt among the repeats by ``salt``: no task takes all rows of one key."""
    own = right.select(surrogate(attrs).alias("_key_"), *[F.col(a).alias(f"_{a}") for a in attrs], value,
                       *([F.col(count).alias("_count")] if count else []))
    keyed = left.withColumn("_key", surrogate(attrs))
    same = reduce(lambda a, b: a + b, [F.col(a).eqNullSafe(F.col(f"_{a}")).cast("int") for a in attrs]) == len(attrs)
    found = (F.col("_key") == F.col("_key_")) & same
    helpers = ["_key", "_key_", *[f"_{a}" for a in attrs]]
    n = right.count()
    if n <= broadcast_rows:
        return keyed.join(F.broadcast(own), found).drop(*helpers, "_count")
    if n <= lookup_rows and own.select("_key_").distinct().count() == n:
        return keyed.join(F.broadcast(own.select("_key_", value)), F.col("_key") == F.col("_key_")).drop("_key", "_key_")
    if not (count and salt):
        return keyed.join(own, found).drop(*helpers, "_count")
    # crowded keys have more than salt_rows rows each, so they are few
    crowded = own.groupBy(F.col("_key_").alias("_crowded")).agg(F.max("_count").alias("_most")).filter(F.col("_most") > salt_rows)
    crowded = broadcast_if_small(crowded.select("_crowded", F.ceil(F.col("_most") / salt_rows).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = keyed.join(crowded, F.col("_key") == F.col("_crowded"), "left").withColumn("_salt", F.pmod(F.xxhash64(salt), salts).cast("int"))
    repeated = own.join(crowded, F.col("_key_") == F.col("_crowded"), "left")
    repeated = repeated.withColumn("_salt_", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_crowded", "_salts", "_count")
    return dealt.drop("_crowded", "_salts").join(repeated, found & (F.col("_salt") == F.col("_salt_"))).drop(*helpers, "_salt", "_salt_")


def fact_policies(gold: DataFrame, vehicles: DataFrame, types: DataFrame, rules: PolicyRules = DEFAULT_RULES,
                  num_partitions: int | None = None, ordered_ids: bool = True, salt_rows: int = SALT_ROWS,
                  broadcast_rows: int = BROADCAST_ROWS, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """One row per gold policy with a known type code; dense ``fact_id`` in
    (insr_begin, insr_end, object_id) order (unique in silver).

    The dimensions are built from this same gold, so each kept gold row matches exactly
    one vehicle (``surrogate_join``) and one type: the lookups keep the row count. Ids come
    from counts by day (``ids.counted_ids``), taken from three columns of gold (date keys are in
    date order): where the vehicles, or their keys and ids, are broadcast, the fact is shuffled once.

    ``vehicles`` may carry ``_policies``, the policies of each (``counted_vehicles``), for the salt.
    ``num_partitions``: about how many partitions the ids are dealt over (default: by rows).
    ``ordered_ids=False`` numbers the rows in storage order instead: no shuffle of the
    fact, ids dense and unique but not in date order."""
    attrs = list(rules.vehicle_attributes)
    known = gold.filter(F.col("insr_type").isNotNull())
    count = "_policies" if "_policies" in vehicles.columns else None
    g = surrogate_join(known, vehicles, attrs, "vehicle_id", count, "object_id", salt_rows, broadcast_rows, lookup_rows)
    # the type codes are a fixed code list
    g = g.join(F.broadcast(types.select("insurance_type_id", "insr_type_code")), g["insr_type"] == F.col("insr_type_code"), "inner")
    keys = [F.col("object_id").cast("long").alias("object_id"), date_key(F.col("insr_begin")).alias("insr_begin_id"),
            date_key(F.col("insr_end")).alias("insr_end_id")]
    rows = g.select(
        keys[0], "vehicle_id", "insurance_type_id", *keys[1:],
        *[(F.col(c).cast(t) if t else F.col(c)).alias(c) for c, t in FACT_MEASURE_COLUMNS],
    )
    if not ordered_ids:
        return storage_ids(rows, "fact_id")
    size = None if num_partitions is None else max(1, -(-known.count() // num_partitions))
    return counted_ids(rows, ["insr_begin_id", "insr_end_id"], "object_id", "fact_id", known.select(*keys), size)


def build_star(gold: DataFrame, rules: PolicyRules = DEFAULT_RULES, ordered_fact_ids: bool = True,
               fact_partitions: int | None = None, vehicle_partitions: int | None = None) -> dict[str, DataFrame]:
    """The four tables. ``gold`` is read several times: pass a written table. Partition counts are
    those the ids are dealt over; by default they follow the row counts (``ids.ROWS_PER_PARTITION``)."""
    spark = gold.sparkSession
    vehicles = stage_table(counted_vehicles(gold, rules, vehicle_partitions), "vehicles")
    types = dim_insurance_type(gold, rules)
    return {
        "dim_vehicle": vehicles.drop("_policies"),
        "dim_insurance_type": types,
        "dim_date": dim_date(spark, rules),
        "fact_policies": fact_policies(gold, vehicles, types, rules, fact_partitions, ordered_fact_ids),
    }
