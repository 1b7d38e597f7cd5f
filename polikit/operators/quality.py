"""Data-quality checks whose findings are DataFrames.

A suite is an ordered list of checks, answered in two ways. All row-level checks become
``count_if`` columns of ONE global aggregate: a task sends one row of counters, and no
column of the table crosses an exchange. Duplicate keys are found beside that on a
128-bit hash of the key alone (``key_duplicates``). Nothing is collected: the findings are
a long-form DataFrame (``inline`` of an array of structs).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import ratio_half_up
from ..rules import DEFAULT_RULES, PolicyRules
from ..schemas import FINDING_COLUMNS

# ---------------------------------------------------------------------------
# Finding vocabulary of the DQ reports.
#   checks: completeness, uniqueness, validity, consistency
#   issues: "null values", "duplicate keys", "zero or negative value",
#           "value not in <sorted list>", "unparseable date (expected <format>)",
#           "end date before start date"
#   key column text: keys joined by " + "; date-order column text: "<end> vs <start>"
#   status: FAIL when row_count > 0, else PASS
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    check: str
    column: str
    issue: str
    violation: Column | str  # true for a violating row (SQL text or Column); null counts as passing


@dataclass(frozen=True)
class Duplicates:
    keys: tuple[str, ...]
    label: str | None = None

    @property
    def column(self) -> str:
        return self.label or " + ".join(self.keys)


def _q(name: str) -> str:
    return f"`{name}`"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def nulls(df: DataFrame, columns=None) -> list[Check]:
    return [Check("completeness", c, "null values", f"{_q(c)} IS NULL") for c in (columns or df.columns)]


def positive(column: str) -> Check:
    return Check("validity", column, "zero or negative value", f"{_q(column)} <= 0")


def at_least(column: str, minimum) -> Check:
    return Check("validity", column, f"value below {minimum}", f"{_q(column)} < {_lit(minimum)}")


def allowed_values(column: str, allowed) -> Check:
    vals = sorted(allowed)
    return Check("validity", column, f"value not in {vals}",
                 f"NOT ({_q(column)} IN ({', '.join(_lit(v) for v in vals)}))")


def _parsed(column: str, fmt: str) -> str:
    return f"try_to_date({_q(column)}, {_lit(fmt)})"


def date_parseable(column: str, fmt: str) -> Check:
    return Check("validity", column, f"unparseable date (expected {fmt})",
                 f"{_q(column)} IS NOT NULL AND {_parsed(column, fmt)} IS NULL")


def date_order(start: str, end: str, fmt: str | None = None) -> Check:
    s, e = (_parsed(start, fmt), _parsed(end, fmt)) if fmt else (_q(start), _q(end))
    return Check("consistency", f"{end} vs {start}", "end date before start date", f"{e} < {s}")


def duplicates(*keys: str) -> Duplicates:
    return Duplicates(tuple(keys))


def _count_if(v: Column | str, name: str) -> Column:
    return (F.expr(f"count_if({v})") if isinstance(v, str) else F.count_if(v)).alias(name)


def pct(n: str, total: str) -> Column:
    """100 * n / total (column names), 2 decimals (exact half-up); 0.0 on an empty table."""
    return F.coalesce(ratio_half_up(f"{n} * 100", total, 2), F.lit(0.0))


def key_hash(keys) -> list[Column]:
    """128 bits of a key, nulls told from values."""
    cols = [F.col(_q(k)) for k in keys]
    nulls = reduce(lambda a, b: a + b, [F.when(c.isNull(), 1 << i).otherwise(0) for i, c in enumerate(cols)])
    return [F.xxhash64(*cols, nulls).alias("_h1"), F.xxhash64(nulls, F.lit("second"), *reversed(cols)).alias("_h2")]


def key_duplicates(df: DataFrame, keys) -> DataFrame:
    """One row: (duplicate_groups, rows_in_duplicate_groups) of the keys seen more than once.

    Rows are counted by a hash of the key, so 24 bytes a row cross the exchange whatever the
    key's width (fewer where keys repeat within a task: a key with a third of all rows is one
    partial count a task). Only rows whose hash is seen twice are then counted by
    the key itself, which tells true duplicates from collisions. A single number is its own hash."""
    keys = list(keys)
    alone = len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, T.NumericType)
    if alone:
        per = df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    else:
        hashed = df.select(*[F.col(_q(k)) for k in keys], *key_hash(keys))
        twice = hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h1", "_h2")
        per = hashed.join(twice, ["_h1", "_h2"], "left_semi").groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return per.filter("_n > 1").agg(F.count(F.lit(1)).alias("duplicate_groups"),
                                    F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_in_duplicate_groups"))


def _totals(df: DataFrame, counts: list[Column], keys=None, dup_name: str = "") -> DataFrame:
    """One row: _total, the counts, and the duplicate groups of ``keys`` under ``dup_name``."""
    totals = df.agg(F.count(F.lit(1)).alias("_total"), *counts)
    if keys is None:
        return totals
    return totals.select("*", key_duplicates(df, keys).select("duplicate_groups").scalar().alias(dup_name))


def suite_totals(df: DataFrame, items: list) -> DataFrame:
    """One row: the rows of ``df`` (_total) and those, or the keys, that each item of a suite finds (_c and its place)."""
    checks = [(i, it) for i, it in enumerate(items) if isinstance(it, Check)]
    dups = [(i, it) for i, it in enumerate(items) if isinstance(it, Duplicates)]
    if len(dups) > 1:
        raise ValueError("one duplicate-key check per suite")
    counts = [_count_if(c.violation, f"_c{i}") for i, c in checks]
    return _totals(df, counts, dups[0][1].keys, f"_c{dups[0][0]}") if dups else _totals(df, counts)


def summed_totals(totals: DataFrame) -> DataFrame:
    """The totals of a table from those of its parts; the rows of a key are in one part."""
    return totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in totals.columns])


def suite_findings(totals: DataFrame, items: list, with_ordinal: bool = False) -> DataFrame:
    """Findings (check, column, issue, row_count, pct, status) in suite order, from the suite's totals."""
    rows = []
    for i, it in enumerate(items):
        kind, issue = (it.check, it.issue) if isinstance(it, Check) else ("uniqueness", "duplicate keys")
        rows.append(f"named_struct('ordinal', {i}, 'check', {_lit(kind)}, 'column', {_lit(it.column)}, "
                    f"'issue', {_lit(issue)}, 'row_count', CAST(_c{i} AS BIGINT))")
    long = totals.selectExpr("_total", f"inline(array({', '.join(rows)}))")
    out = long.select(
        "ordinal", "check", "column", "issue", "row_count", pct("row_count", "_total").alias("pct"),
        F.expr("CASE WHEN row_count > 0 THEN 'FAIL' ELSE 'PASS' END").alias("status"),
    )
    return out if with_ordinal else out.select(*FINDING_COLUMNS)


def run_suite(df: DataFrame, items: list, with_ordinal: bool = False) -> DataFrame:
    """Findings (check, column, issue, row_count, pct, status) in suite order."""
    return suite_findings(suite_totals(df, items), items, with_ordinal)


def bronze_suite(df: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> list:
    fmt = rules.date_format
    return (nulls(df) + [duplicates(*rules.policy_key), positive("PREMIUM"), positive("INSURED_VALUE"),
                         allowed_values("SEX", rules.sex_domain), date_parseable("INSR_BEGIN", fmt),
                         date_parseable("INSR_END", fmt), date_order("INSR_BEGIN", "INSR_END", fmt)])


def silver_suite(df: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> list:
    return (nulls(df) + [duplicates(*[k.lower() for k in rules.policy_key]), positive("premium"),
                         allowed_values("sex", rules.sex_domain), date_order("insr_begin", "insr_end"),
                         allowed_values("premium_segment", rules.premium_segments),
                         allowed_values("value_segment", rules.value_segments)])


GOLD_CHECK_COLUMNS = ["lifecycle_status", "is_active", "is_expired", "renewal_candidate", "risk_score"]


def gold_suite(df: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> list:
    return (nulls(df, GOLD_CHECK_COLUMNS) + [allowed_values("lifecycle_status", rules.lifecycle_domain),
                                             allowed_values("risk_score", rules.risk_domain)])


def silver_spec_suite(rules: PolicyRules = DEFAULT_RULES) -> list:
    """Checks the written spec asks of silver that the coded suite lacks."""
    return [at_least("vehicle_age", 0), positive("policy_duration_days")]


def dq_bronze(df: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return run_suite(df, bronze_suite(df, rules))


def dq_silver(df: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return run_suite(df, silver_suite(df, rules))


def dq_gold(df: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return run_suite(df.select(*GOLD_CHECK_COLUMNS), gold_suite(df, rules))


def summarize(layers: dict[str, DataFrame]) -> DataFrame:
    """FAILs out of checks per layer."""
    tagged = [f.select(F.lit(name).alias("layer"), "status") for name, f in layers.items()]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    return u.groupBy("layer").agg(F.count(F.lit(1)).alias("check_count"),
                                  F.count_if(F.col("status") == "FAIL").alias("fail_count"))


def primary_key_findings(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Not-null + unique per table key, as findings ('table.key' in the column text)."""
    out = []
    for name, (df, key) in tables.items():
        label = f"{name}.{key}"
        k = df.select(F.col(key).alias("_pk"))
        out.append(run_suite(k, [Check("completeness", label, "null values", "_pk IS NULL"),
                                 Duplicates(("_pk",), label)]))
    return reduce(lambda a, b: a.unionByName(b), out)


def foreign_key_findings(child: DataFrame, child_name: str, refs: list[tuple[str, DataFrame, str, str]],
                         broadcast_parents: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose non-null foreign key has no parent row (a null key passes).

    Per reference: the child is reduced to (key, rows) per distinct key (partial
    aggregation), left-joined to the distinct parent keys, and summed: the join sees
    distinct keys, never policy rows. Explicit broadcast only for parents whose size is
    fixed (the calendar); the others are left to AQE's runtime size check.
    """
    parts = []
    for fk, parent, pk, parent_name in refs:
        keys = child.groupBy(fk).agg(F.count(F.lit(1)).alias("_rows"))
        p = parent.select(F.col(pk).alias("_pk")).distinct()
        if parent_name in broadcast_parents:
            p = F.broadcast(p)
        j = keys.join(p, keys[fk] == p["_pk"], "left")
        missing = F.col(fk).isNotNull() & F.col("_pk").isNull()
        parts.append(j.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("_total"),
            F.coalesce(F.sum(F.when(missing, F.col("_rows"))), F.lit(0)).cast("long").alias("row_count"))
            .select(F.lit("referential integrity").alias("check"), F.lit(f"{child_name}.{fk}").alias("column"),
                    F.lit(f"missing in {parent_name}.{pk}").alias("issue"), "row_count",
                    pct("row_count", "_total").alias("pct"),
                    F.when(F.col("row_count") > 0, "FAIL").otherwise("PASS").alias("status")))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------------------------------------
# EDA finding table vocabulary.
#   dimensions: Completeness, Validity, Consistency, Uniqueness
#   issues: "Null / empty: <n>", "Cannot parse as dd-MMM-yy: <n>", "INSR_END < INSR_BEGIN: <n>",
#           "Zero or negative: <n>", "Value not in {0,1}: <n>", "Duplicate policy keys (<n> groups)"
#           (<n> with thousands separators)
#   actions: "keep (expected: no-claim rows)" for CLAIM_PAID nulls, else "investigate";
#            "drop row" for dates, order, PREMIUM, INSURED_VALUE; "flag" for SEX;
#            "dropDuplicates" for duplicate keys
#   order column text: "INSR_BEGIN / INSR_END"
# ---------------------------------------------------------------------------
EDA_COLUMNS = ["column", "dq_dimension", "issue", "row_count", "pct", "action"]


def eda_findings(df: DataFrame, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """Profiling findings of the raw feed: only non-zero findings, each with an action.

    Answered in two ways like ``run_suite``."""
    fmt = rules.date_format
    b, e = _parsed("INSR_BEGIN", fmt), _parsed("INSR_END", fmt)
    specs = []  # (column, dimension, prefix, suffix, violation SQL, action)
    for c in df.columns:
        action = "keep (expected: no-claim rows)" if c == "CLAIM_PAID" else "investigate"
        specs.append((c, "Completeness", "Null / empty: ", "",
                      f"{_q(c)} IS NULL OR CAST({_q(c)} AS STRING) = ''", action))
    for c, parsed in (("INSR_BEGIN", b), ("INSR_END", e)):
        specs.append((c, "Validity", f"Cannot parse as {fmt}: ", "", f"{parsed} IS NULL AND {_q(c)} IS NOT NULL",
                      "drop row"))
    specs.append(("INSR_BEGIN / INSR_END", "Consistency", "INSR_END < INSR_BEGIN: ", "", f"{e} < {b}", "drop row"))
    specs.append(("PREMIUM", "Validity", "Zero or negative: ", "", "PREMIUM <= 0", "drop row"))
    specs.append(("INSURED_VALUE", "Validity", "Zero or negative: ", "", "INSURED_VALUE <= 0", "drop row"))
    dom = ",".join(str(v) for v in rules.eda_sex_domain)
    specs.append(("SEX", "Validity", f"Value not in {{{dom}}}: ", "",
                  f"NOT (SEX IN ({', '.join(_lit(v) for v in rules.eda_sex_domain)}))", "flag"))
    keys = list(rules.policy_key)
    totals = _totals(df, [_count_if(sp[4], f"_c{i}") for i, sp in enumerate(specs)], keys, f"_c{len(specs)}")
    specs.append((" + ".join(keys), "Uniqueness", "Duplicate policy keys (", " groups)", None, "dropDuplicates"))
    rows = [f"named_struct('ordinal', {i}, 'column', {_lit(sp[0])}, 'dq_dimension', {_lit(sp[1])}, "
            f"'_pre', {_lit(sp[2])}, '_suf', {_lit(sp[3])}, 'row_count', CAST(_c{i} AS BIGINT), "
            f"'action', {_lit(sp[5])})" for i, sp in enumerate(specs)]
    long = totals.selectExpr("_total", f"inline(array({', '.join(rows)}))").filter("row_count > 0")
    return long.select(
        "column", "dq_dimension", F.expr("concat(_pre, format_number(row_count, 0), _suf)").alias("issue"),
        "row_count", pct("row_count", "_total").alias("pct"), "action")


# The report's titles with the columns they show and their widths (negative:
# flush left); the share has two decimals and the status follows after two blanks.
REPORT_LAYOUT = (("CHECK", "check", -20), ("COLUMN", "column", -35), ("ISSUE", "issue", -25), ("ROWS", "row_count", 8),
                 ("%", "pct", 7), ("STATUS", "status", None))


def _cell(width: int | None, kind: str = "s") -> str:
    return f" %{kind}" if width is None else f"%{width}{kind}"


def report_line() -> Column:
    """Fixed-width report line of a finding row."""
    shown = {"row_count": F.format_number("row_count", 0)}
    layout = " ".join(_cell(w, ".2f" if column == "pct" else "s") for _, column, w in REPORT_LAYOUT)
    return F.format_string(layout, *[shown.get(column, F.col(column)) for _, column, _ in REPORT_LAYOUT])


def report_lines(findings: DataFrame) -> DataFrame:
    return findings.select(report_line().alias("line"))


def report_header() -> str:
    return " ".join(_cell(w) for _, _, w in REPORT_LAYOUT) % tuple(title for title, _, _ in REPORT_LAYOUT)
