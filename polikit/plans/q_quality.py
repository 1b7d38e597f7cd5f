"""Registered queries: data-quality suites, profiling, proposed derived columns, I/O round trips."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..operators import profile as PF
from ..operators import quality as Q
from ..operators.clean import to_silver
from ..operators.lifecycle import to_gold
from ..operators.staging import release_staged, shuffles_dropped, stage_table, staged_mark
from ..rules import DEFAULT_RULES as R
from ..schemas import RAW_SCHEMA
from ..session import ensure_checkpoint_dir
from ..sources import feed, files
from ..sources.feed import policy_feed_files
from . import layers as L
from . import oracle as O
from .registry import register

FMT_TEXT = "dd-MMM-yy"


def _q(s: str) -> str:
    return s.replace("'", "''")


# -- SQL side: findings ---------------------------------------------------------------

def f_sql(src: str, check: str, column: str, issue: str, cond: str | None = None, dup_keys=None) -> str:
    if dup_keys is not None:
        k = ", ".join(dup_keys)
        n = f"(SELECT count(*) FROM (SELECT {k} FROM {src} GROUP BY {k} HAVING count(*) > 1) d)"
    else:
        n = f"(SELECT count(*) FILTER (WHERE {cond}) FROM {src})"
    total = f"(SELECT count(*) FROM {src})"
    return (f"SELECT '{check}' AS \"check\", '{_q(column)}' AS \"column\", '{_q(issue)}' AS issue, "
            f"CAST({n} AS BIGINT) AS row_count, COALESCE({O.rhu('100 * ' + n, total, 2)}, 0.0) AS pct, "
            f"CASE WHEN {n} > 0 THEN 'FAIL' ELSE 'PASS' END AS status")


def nulls_sql(src, cols):
    return [f_sql(src, "completeness", c, "null values", f"{c} IS NULL") for c in cols]


def allowed_sql(src, col, vals):
    lit = ", ".join(repr(v) if not isinstance(v, str) else f"'{v}'" for v in sorted(vals))
    return f_sql(src, "validity", col, f"value not in {sorted(vals)}", f"{col} NOT IN ({lit})")


def parse_sql(col):
    return f"CAST(try_strptime({col}, {O.FMT}) AS DATE)"


def bronze_items_sql():
    s = "bronze"
    return (nulls_sql(s, O.RAW)
            + [f_sql(s, "uniqueness", " + ".join(O.KEY), "duplicate keys", dup_keys=O.KEY),
               f_sql(s, "validity", "PREMIUM", "zero or negative value", "PREMIUM <= 0"),
               f_sql(s, "validity", "INSURED_VALUE", "zero or negative value", "INSURED_VALUE <= 0"),
               allowed_sql(s, "SEX", [0, 1, 2]),
               f_sql(s, "validity", "INSR_BEGIN", f"unparseable date (expected {FMT_TEXT})",
                     f"INSR_BEGIN IS NOT NULL AND {parse_sql('INSR_BEGIN')} IS NULL"),
               f_sql(s, "validity", "INSR_END", f"unparseable date (expected {FMT_TEXT})",
                     f"INSR_END IS NOT NULL AND {parse_sql('INSR_END')} IS NULL"),
               f_sql(s, "consistency", "INSR_END vs INSR_BEGIN", "end date before start date",
                     f"{parse_sql('INSR_END')} < {parse_sql('INSR_BEGIN')}")])


def silver_items_sql():
    s = "silver"
    keys = [k.lower() for k in O.KEY]
    return (nulls_sql(s, O.SILVER)
            + [f_sql(s, "uniqueness", " + ".join(keys), "duplicate keys", dup_keys=keys),
               f_sql(s, "validity", "premium", "zero or negative value", "premium <= 0"),
               allowed_sql(s, "sex", [0, 1, 2]),
               f_sql(s, "consistency", "insr_end vs insr_begin", "end date before start date", "insr_end < insr_begin"),
               allowed_sql(s, "premium_segment", ["low", "medium", "high"]),
               allowed_sql(s, "value_segment", ["low", "medium", "high", "unknown"])])


def gold_items_sql():
    return (nulls_sql("gold", Q.GOLD_CHECK_COLUMNS)
            + [allowed_sql("gold", "lifecycle_status", ["active", "expired", "future"]),
               allowed_sql("gold", "risk_score", [0, 1, 2, 3])])


def union(items):
    return "\nUNION ALL\n".join(items)


# -- DQ suites ---------------------------------------------------------------------------

@register("dq_bronze", O.with_ctes("bronze", union(bronze_items_sql())))
def dq_bronze(spark, sf):
    return Q.dq_bronze(L.bronze(spark, sf))


@register("dq_silver", O.with_ctes("silver", union(silver_items_sql())))
def dq_silver(spark, sf):
    """Silver is written once: the counts and the duplicate check read it, not the joins and the grouping twice."""
    return Q.dq_silver(stage_table(L.silver(spark, sf), "silver"))


@register("dq_gold", O.with_ctes("gold", union(gold_items_sql())))
def dq_gold(spark, sf):
    return Q.dq_gold(L.gold(spark, sf))


@register("dq_nulls", O.with_ctes("bronze", union(nulls_sql("bronze", O.RAW))))
def dq_nulls(spark, sf):
    b = L.bronze(spark, sf)
    return Q.run_suite(b, Q.nulls(b))


@register("dq_duplicates", O.with_ctes("bronze", bronze_items_sql()[16]))
def dq_duplicates(spark, sf):
    return Q.run_suite(L.bronze(spark, sf), [Q.duplicates(*R.policy_key)])


@register("dq_positive", O.with_ctes("bronze", union(bronze_items_sql()[17:19])))
def dq_positive(spark, sf):
    return Q.run_suite(L.bronze(spark, sf), [Q.positive("PREMIUM"), Q.positive("INSURED_VALUE")])


@register("dq_allowed_values", O.with_ctes("bronze", bronze_items_sql()[19]))
def dq_allowed_values(spark, sf):
    return Q.run_suite(L.bronze(spark, sf), [Q.allowed_values("SEX", R.sex_domain)])


@register("dq_date_parseable", O.with_ctes("bronze", union(bronze_items_sql()[20:22])))
def dq_date_parseable(spark, sf):
    return Q.run_suite(L.bronze(spark, sf), [Q.date_parseable("INSR_BEGIN", R.date_format),
                                             Q.date_parseable("INSR_END", R.date_format)])


@register("dq_date_order", O.with_ctes("bronze", bronze_items_sql()[22]))
def dq_date_order(spark, sf):
    return Q.run_suite(L.bronze(spark, sf), [Q.date_order("INSR_BEGIN", "INSR_END", R.date_format)])


@register("dq_summary", O.with_ctes("gold", f"""
SELECT layer, COUNT(*) AS check_count, COUNT(*) FILTER (WHERE status = 'FAIL') AS fail_count FROM (
  SELECT 'bronze' AS layer, status FROM ({union(bronze_items_sql())}) b
  UNION ALL SELECT 'silver', status FROM ({union(silver_items_sql())}) s
  UNION ALL SELECT 'gold', status FROM ({union(gold_items_sql())}) g) t GROUP BY layer"""))
def dq_summary(spark, sf):
    """The feed is taken in parts of whole order keys, so what lies on disk at a time is a part's. Of each, bronze is
    written, silver, which follows from it, too, and gold follows row by row; the suites read these, and their totals add
    up over the parts: no policy key is in two."""
    found: dict[str, list] = {"bronze": [], "silver": [], "gold": []}
    for part in feed.parts(spark, sf):
        mark = staged_mark()
        with shuffles_dropped(spark):
            b = stage_table(L.bronze(spark, sf, part=part), "bronze")
            s = stage_table(to_silver(b), "silver")
            g = to_gold(s).select(*Q.GOLD_CHECK_COLUMNS)
            suites = {"bronze": (b, Q.bronze_suite(b)), "silver": (s, Q.silver_suite(s)), "gold": (g, Q.gold_suite(g))}
            for layer, (df, items) in suites.items():
                found[layer].append(Q.suite_totals(df, items).first())  # a row of counters
        release_staged(spark, mark)
    return Q.summarize({layer: Q.suite_findings(Q.summed_totals(_frame(spark, found[layer])), items)
                        for layer, (_, items) in suites.items()})


def _frame(spark, counters: list):
    return spark.createDataFrame(counters, ", ".join(f"`{c}` long" for c in counters[0].__fields__))


@register("dq_silver_spec", O.with_ctes("silver", union([
    f_sql("silver", "validity", "vehicle_age", "value below 0", "vehicle_age < 0"),
    f_sql("silver", "validity", "policy_duration_days", "zero or negative value", "policy_duration_days <= 0")])))
def dq_silver_spec(spark, sf):
    return Q.run_suite(L.silver(spark, sf), Q.silver_spec_suite())


PK = [("dim_vehicle", "vehicle_id"), ("dim_insurance_type", "insurance_type_id"), ("dim_date", "date_id"),
      ("fact_policies", "fact_id")]
_CTE = {"dim_vehicle": "dim_vehicle", "dim_insurance_type": "dim_insurance_type", "dim_date": "dim_date",
        "fact_policies": "fact"}


@register("dq_primary_keys", O.with_ctes("fact", union(
    [x for t, k in PK for x in (
        f_sql(_CTE[t], "completeness", f"{t}.{k}", "null values", f"{k} IS NULL"),
        f_sql(_CTE[t], "uniqueness", f"{t}.{k}", "duplicate keys", dup_keys=[k]))])))
def dq_primary_keys(spark, sf):
    st = L.star(spark, sf)
    return Q.primary_key_findings({t: (st[t], k) for t, k in PK})


FK = [("vehicle_id", "dim_vehicle", "vehicle_id"), ("insurance_type_id", "dim_insurance_type", "insurance_type_id"),
      ("insr_begin_id", "dim_date", "date_id"), ("insr_end_id", "dim_date", "date_id")]


@register("dq_foreign_keys", O.with_ctes("fact", union([
    f_sql("fact", "referential integrity", f"fact_policies.{fk}", f"missing in {pt}.{pk}",
          f"{fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {pt} WHERE {pk} IS NOT NULL)")
    for fk, pt, pk in FK])))
def dq_foreign_keys(spark, sf):
    st = L.star(spark, sf)
    return Q.foreign_key_findings(st["fact_policies"], "fact_policies",
                                  [(fk, st[pt], pk, pt) for fk, pt, pk in FK], broadcast_parents=("dim_date",))


def _eda_sql():
    s, tot = "bronze", "(SELECT count(*) FROM bronze)"

    def row(col, dim, pre, suf, n, action):
        return (f"SELECT '{col}' AS \"column\", '{dim}' AS dq_dimension, "
                f"'{_q(pre)}' || format('{{:,}}', {n}) || '{_q(suf)}' AS issue, CAST({n} AS BIGINT) AS row_count, "
                f"COALESCE({O.rhu('100 * ' + n, tot, 2)}, 0.0) AS pct, '{_q(action)}' AS action")
    items = []
    for c in O.RAW:
        n = f"(SELECT count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = '') FROM {s})"
        items.append(row(c, "Completeness", "Null / empty: ", "", n,
                         "keep (expected: no-claim rows)" if c == "CLAIM_PAID" else "investigate"))
    for c in ("INSR_BEGIN", "INSR_END"):
        n = f"(SELECT count(*) FILTER (WHERE {parse_sql(c)} IS NULL AND {c} IS NOT NULL) FROM {s})"
        items.append(row(c, "Validity", f"Cannot parse as {FMT_TEXT}: ", "", n, "drop row"))
    n = f"(SELECT count(*) FILTER (WHERE {parse_sql('INSR_END')} < {parse_sql('INSR_BEGIN')}) FROM {s})"
    items.append(row("INSR_BEGIN / INSR_END", "Consistency", "INSR_END < INSR_BEGIN: ", "", n, "drop row"))
    for c in ("PREMIUM", "INSURED_VALUE"):
        items.append(row(c, "Validity", "Zero or negative: ", "", f"(SELECT count(*) FILTER (WHERE {c} <= 0) FROM {s})",
                         "drop row"))
    items.append(row("SEX", "Validity", "Value not in {0,1}: ", "",
                     f"(SELECT count(*) FILTER (WHERE SEX NOT IN (0, 1)) FROM {s})", "flag"))
    k = ", ".join(O.KEY)
    items.append(row(" + ".join(O.KEY), "Uniqueness", "Duplicate policy keys (", " groups)",
                     f"(SELECT count(*) FROM (SELECT {k} FROM {s} GROUP BY {k} HAVING count(*) > 1) d)",
                     "dropDuplicates"))
    return f"SELECT * FROM ({union(items)}) t WHERE row_count > 0"


@register("dq_profile_findings", O.with_ctes("bronze", _eda_sql()))
def dq_profile_findings(spark, sf):
    return Q.eda_findings(L.bronze(spark, sf))


@register("dq_duplicate_groups", O.with_ctes("bronze", f"""
SELECT count(*) FILTER (WHERE n > 1) AS duplicate_groups,
       CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicate_groups,
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_rows
FROM (SELECT count(*) AS n FROM bronze GROUP BY {', '.join(O.KEY)}) t"""))
def dq_duplicate_groups(spark, sf):
    return PF.duplicate_groups(L.bronze(spark, sf), R.policy_key)


@register("dq_report_lines", O.with_ctes("bronze", f"""
SELECT printf('%-20s %-35s %-25s %8s %7.2f  %s', "check", "column", issue, format('{{:,}}', row_count), pct, status)
       AS line FROM ({union(bronze_items_sql())}) f"""))
def dq_report_lines(spark, sf):
    return Q.report_lines(Q.dq_bronze(L.bronze(spark, sf)))


# -- profiling -------------------------------------------------------------------------------

def _counts_sql(column: str) -> str:
    return f"SELECT '{column}' AS column_name, CAST({column} AS VARCHAR) AS value, count(*) AS row_count FROM bronze GROUP BY 2"


@register("prf_value_counts", O.with_ctes("bronze", union([_counts_sql(c) for c in PF.FREQ_COLUMNS])))
def prf_value_counts(spark, sf):
    return PF.value_counts(L.bronze(spark, sf))


@register("prf_top_values", O.with_ctes("bronze", union([
    f"SELECT * FROM ({_counts_sql(c)} ORDER BY row_count DESC, value ASC NULLS LAST LIMIT 20) t{i}"
    for i, c in enumerate(PF.FREQ_TOP)])))
def prf_top_values(spark, sf):
    return PF.top_values(L.bronze(spark, sf))


@register("prf_date_range", O.with_ctes("bronze", f"""
SELECT strftime(min({parse_sql('INSR_BEGIN')}), '%Y-%m-%d') AS min_insr_begin,
       strftime(max({parse_sql('INSR_BEGIN')}), '%Y-%m-%d') AS max_insr_begin,
       strftime(min({parse_sql('INSR_END')}), '%Y-%m-%d') AS min_insr_end,
       strftime(max({parse_sql('INSR_END')}), '%Y-%m-%d') AS max_insr_end FROM bronze"""))
def prf_date_range(spark, sf):
    return L.portable(PF.date_range(L.bronze(spark, sf)))


def _pct_sql(src, col, probs):
    vals = ", ".join(f"('{lbl}', {i}, {num}, {den})" for i, (lbl, num, den) in enumerate(probs))
    return (f"SELECT '{col}' AS column_name, p.label AS percentile, p.ord AS ordinal, CAST(r.x AS DOUBLE) AS value "
            f"FROM (VALUES {vals}) p(label, ord, num, den) "
            f"JOIN (SELECT {col} AS x, row_number() OVER (ORDER BY {col}) AS rn, count(*) OVER () AS n "
            f"      FROM {src} WHERE {col} IS NOT NULL) r "
            f"ON r.rn = greatest(1, (p.num * r.n + p.den - 1) // p.den)")


@register("prf_percentiles_exact", O.with_ctes("bronze", union(
    [_pct_sql("bronze", c, PF.PERCENTILES) for c in PF.PERCENTILE_COLUMNS])))
def prf_percentiles_exact(spark, sf):
    values = stage_table(L.bronze(spark, sf).select(*PF.PERCENTILE_COLUMNS), "profiled")
    return PF.percentiles_exact(values).drop("exact_value")


@register("prf_percentiles_approx", O.with_ctes("bronze", union([
    f"SELECT '{c}' AS column_name, '{lbl}' AS percentile, {i} AS ordinal, count({c}) > 0 AS within_bound FROM bronze"
    for c in PF.PERCENTILE_COLUMNS for i, (lbl, _, _) in enumerate(PF.PERCENTILES)])))
def prf_percentiles_approx(spark, sf):
    return PF.approx_rank_check(L.bronze(spark, sf))


_SCALES = {"INSURED_VALUE": 2, "PREMIUM": 4, "CARRYING_CAPACITY": 2, "CCM_TON": 2, "CLAIM_PAID": 2}
_TEXTS = ("INSR_BEGIN", "INSR_END", "EFFECTIVE_YR", "TYPE_VEHICLE", "MAKE", "USAGE")


def _describe_sql(c: str) -> str:
    mean, spread = "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"
    if c not in _TEXTS:
        mean = O.rhu(f"SUM({c})", f"COUNT({c})", 4, _SCALES.get(c, 0))
        spread = f"CAST(printf('%.5e', stddev_samp(CAST({c} AS DOUBLE))) AS DOUBLE)"
    return (f"SELECT '{c}' AS column_name, count({c}) AS n, {mean} AS mean, {spread} AS stddev, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM bronze")


@register("prf_describe", O.with_ctes("bronze", union([_describe_sql(c) for c in O.RAW])))
def prf_describe(spark, sf):
    return PF.describe(L.bronze(spark, sf))


@register("prf_null_counts", O.with_ctes("bronze", union(
    [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM bronze" for c in O.RAW])))
def prf_null_counts(spark, sf):
    return PF.null_counts(L.bronze(spark, sf))


@register("prf_null_or_empty", O.with_ctes("bronze", union(
    [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = '') "
     f"AS null_or_empty_count FROM bronze" for c in O.RAW])))
def prf_null_or_empty(spark, sf):
    return PF.null_or_empty_counts(L.bronze(spark, sf))


def _cut_sql(col, ord_):
    return (f"(SELECT x FROM (SELECT {col} AS x, row_number() OVER (ORDER BY {col}) AS rn, "
            f"count(*) OVER () AS n FROM silver WHERE {col} IS NOT NULL) r "
            f"WHERE rn = greatest(1, ({ord_} * n + 99) // 100))")


def _seg_sql(col, lo, hi):
    return (f"CASE WHEN {col} IS NULL THEN 'Unknown' WHEN {col} < {lo} THEN 'Low' WHEN {col} < {hi} THEN 'Medium' "
            f"ELSE 'High' END")


@register("drv_quantile_segments", O.with_ctes("silver", f"""
SELECT object_id, strftime(insr_begin, '%Y-%m-%d') AS insr_begin, strftime(insr_end, '%Y-%m-%d') AS insr_end,
       {_seg_sql('premium', _cut_sql('premium', 33), _cut_sql('premium', 66))} AS premium_segment_q,
       {_seg_sql('insured_value', _cut_sql('insured_value', 33), _cut_sql('insured_value', 66))} AS value_segment_q
FROM silver"""))
def drv_quantile_segments(spark, sf):
    return L.portable(PF.quantile_segments(stage_table(L.silver(spark, sf), "silver")))


@register("drv_effective_year", O.with_ctes("silver", """
SELECT object_id, strftime(insr_begin, '%Y-%m-%d') AS insr_begin, strftime(insr_end, '%Y-%m-%d') AS insr_end,
       effective_yr, CAST(TRY_CAST(effective_yr AS INTEGER) + 2000 AS INTEGER) AS effective_year FROM silver"""))
def drv_effective_year(spark, sf):
    s = L.silver(spark, sf).select("object_id", "insr_begin", "insr_end", "effective_yr")
    return L.portable(PF.effective_year(s))


@register("drv_anomaly_flag", O.with_ctes("bronze", """
SELECT OBJECT_ID AS object_id, SEX AS sex, NOT COALESCE(SEX IN (0, 1), FALSE) AS sex_flag FROM bronze"""))
def drv_anomaly_flag(spark, sf):
    b = L.bronze(spark, sf).select(F.col("OBJECT_ID").alias("object_id"), F.col("SEX").alias("sex"))
    return PF.anomaly_flag(b, "sex", R.eda_sex_domain)


@register("prf_regex_violations", O.with_ctes("gold", r"""
SELECT DISTINCT effective_yr FROM gold WHERE NOT regexp_matches(effective_yr, '^\d+$')"""))
def prf_regex_violations(spark, sf):
    return PF.regex_violations(L.gold(spark, sf), "effective_yr")


# -- sources / sinks round trips ---------------------------------------------------------------

def _scratch(spark, name: str) -> str:
    """A fresh folder next to the checkpoints (the shared folder the cluster names)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/io-{uuid.uuid4().hex}/{name}"


@register("src_csv_roundtrip", O.with_ctes("bronze", f"SELECT {O.portable(O.RAW)} FROM bronze"))
def src_csv_roundtrip(spark, sf):
    path = _scratch(spark, "bronze_csv")
    files.write_csv(L.bronze(spark, sf), path)
    return L.portable(files.read_csv(spark, path, RAW_SCHEMA))


@register("src_csv_two_files", O.with_ctes("bronze", f"SELECT {O.portable(O.RAW)} FROM bronze"))
def src_csv_two_files(spark, sf):
    """The two period files, whose columns come in different orders, written, read and united."""
    paths = [_scratch(spark, "period_csv") for _ in range(2)]
    for df, path in zip(policy_feed_files(spark, sf), paths, strict=True):
        files.write_csv(df, path)
    return L.portable(files.read_csv(spark, paths, RAW_SCHEMA))


@register("snk_parquet_roundtrip", O.with_ctes("gold", f"SELECT {O.portable(O.GOLD)} FROM gold"))
def snk_parquet_roundtrip(spark, sf):
    path = _scratch(spark, "gold_parquet")
    files.write_parquet(L.gold(spark, sf), path)
    return L.portable(files.read_parquet(spark, path))


_KEY_TEXT = {"dim_vehicle": ["vehicle_id", "make", "type_vehicle", "seats_num", "usage"],
             "dim_insurance_type": ["insurance_type_id", "insr_type_code", "insr_type_name"],
             "dim_date": ["date_id", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name"],
             "fact_policies": ["fact_id", "object_id", "vehicle_id", "insurance_type_id", "insr_begin_id", "insr_end_id",
                               "prod_year", "sex", "policy_duration_days", "vehicle_age", "premium_segment",
                               "value_segment", "lifecycle_status", "risk_score"]}


def _row_text_sql(table: str) -> str:
    cols = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _KEY_TEXT[table])
    return f"SELECT '{table}' AS table_name, {cols} AS row_text FROM {_CTE[table]}"


@register("snk_star_tables", O.with_ctes("fact", union([_row_text_sql(t) for t in _KEY_TEXT])))
def snk_star_tables(spark, sf):
    """The star tables written and read back: every row, its key and attribute columns as text."""
    st = L.star(spark, sf)
    base = _scratch(spark, "star")
    parts = []
    for name, cols in _KEY_TEXT.items():
        files.write_parquet(st[name], f"{base}/{name}")
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])
        parts.append(files.read_parquet(spark, f"{base}/{name}").select(F.lit(name).alias("table_name"), text.alias("row_text")))
    return reduce(lambda a, b: a.unionByName(b), parts)
