"""Profiling of the raw feed (EDA): frequencies, ranges, percentiles, statistics,
null counts, proposed derived columns. Long-form DataFrames, one fused pass where
the measures allow it; only counters of a bounded number pass through the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date
from ..functions.money import ratio_half_up_sql
from ..rules import DEFAULT_RULES
from .quality import key_duplicates
from .staging import stage_table

# ---------------------------------------------------------------------------
# Fixed values of the EDA profile:
#   frequency tables: TYPE_VEHICLE, USAGE, INSR_TYPE, SEX, MAKE, INSURED_VALUE (all values)
#   previews: the top 20 of MAKE and INSURED_VALUE
#   percentile columns: PREMIUM, INSURED_VALUE, CCM_TON
#   percentile labels / fractions: min 0, p25 0.25, median 0.5, p75 0.75, p95 0.95, p99 0.99, max 1
#   data-driven segment cuts: 33rd and 66th percentile, labels Low / Medium / High
#   EFFECTIVE_YR: 2-digit year + 2000
#   anomaly flag: SEX outside {0, 1} -> sex_flag
#   numeric-code pattern: ^\d+$
# ---------------------------------------------------------------------------
FREQ_COLUMNS = ["TYPE_VEHICLE", "USAGE", "INSR_TYPE", "SEX", "MAKE", "INSURED_VALUE"]
FREQ_TOP = ["MAKE", "INSURED_VALUE"]
FREQ_TOP_N = 20
PERCENTILE_COLUMNS = ["PREMIUM", "INSURED_VALUE", "CCM_TON"]
PERCENTILES = [("min", 0, 100), ("p25", 25, 100), ("median", 50, 100), ("p75", 75, 100), ("p95", 95, 100),
               ("p99", 99, 100), ("max", 100, 100)]
SEGMENT_CUTS = [("p33", 33, 100), ("p66", 66, 100)]
APPROX_ACCURACY = 10_000
NUMERIC_CODE = r"^\d+$"


def _long(df: DataFrame, entries: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*entries)))


def _q(name: str) -> str:
    return f"`{name}`"


def _long_sql(df: DataFrame, structs: list[str]) -> DataFrame:
    """Long form from SQL ``named_struct`` texts: one JVM call for the whole array."""
    return df.selectExpr(f"inline(array({', '.join(structs)}))")


def value_counts(df: DataFrame, columns=FREQ_COLUMNS) -> DataFrame:
    """(column_name, value, row_count): every value of every column, from one scan and one
    partially aggregated shuffle of (column, value) pairs."""
    pairs = _long_sql(df, [f"named_struct('column_name', '{c}', 'value', CAST({_q(c)} AS STRING))" for c in columns])
    return pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def top_values(df: DataFrame, columns=FREQ_TOP, top_n: int = FREQ_TOP_N) -> DataFrame:
    """The ``top_n`` most frequent values of each column (count desc, value asc), for a preview.

    The pair counts are staged (one row per distinct pair), so the per-column branches do
    not rescan the input; each is a distributed take-ordered, not a window over all values."""
    counts = stage_table(value_counts(df, columns), "value_counts")
    parts = [counts.filter(F.col("column_name") == c)
             .orderBy(F.desc("row_count"), F.asc_nulls_last("value")).limit(top_n) for c in columns]
    return reduce(lambda a, b: a.unionByName(b), parts)


def date_range(df: DataFrame, fmt: str = DEFAULT_RULES.date_format) -> DataFrame:
    b, e = parse_date(F.col("INSR_BEGIN"), fmt), parse_date(F.col("INSR_END"), fmt)
    return df.agg(F.min(b).alias("min_insr_begin"), F.max(b).alias("max_insr_begin"),
                  F.min(e).alias("min_insr_end"), F.max(e).alias("max_insr_end"))


def _common_type(df: DataFrame, columns) -> str:
    """A numeric type holding every column exactly (decimal when all are decimal)."""
    types = [df.schema[c].dataType for c in columns]
    if all(isinstance(t, T.DecimalType) for t in types):
        scale = max(t.scale for t in types)
        digits = max(t.precision - t.scale for t in types)
        return f"decimal({min(38, digits + scale)},{scale})"
    if all(isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)) for t in types):
        return "long"
    return "double"


#: Bins of a range, and rows of a range that are told apart by value at once.
BINS = 1024


def _bin(x: str, low: str, high: str, floating: bool) -> str:
    """SQL text: the bin of ``x`` in [low, high], 0 to BINS - 1, rising with ``x``; ``low`` and ``high`` differ,
    so they fall in different bins. Exact differences are taken before any rounding."""
    def from_low(v: str) -> str:
        # halves, as a difference of doubles may exceed doubles
        return f"({v} / 2 - {low} / 2)" if floating else f"CAST({v} - {low} AS DOUBLE)"
    return f"CAST(LEAST({BINS - 1}, FLOOR({from_low(x)} / {from_low(high)} * {BINS})) AS INT)"


def percentiles_exact(df: DataFrame, columns=PERCENTILE_COLUMNS, probs=PERCENTILES) -> DataFrame:
    """Discrete percentiles (the first value whose cumulative share reaches p), exact, for several
    columns: (column_name, percentile, ordinal, exact_value, value).

    Selection by repeated histograms. The first pass gives each column's rows, least and greatest
    value; each later one counts the values of the open ranges (those that hold a target
    rank) by bin, with each bin's least and greatest value, and the bin that holds the rank is
    the next range. A range of at most ``BINS`` rows is counted by value, which ends it, as does
    one whose least and greatest value agree. A pass is one scan and one aggregate of at most
    ranges x BINS groups, combined in each task: no value is sorted, staged or shuffled, and a value
    that a third of all rows have is one counter. Passes grow with the logarithm of a column's range,
    not with the rows. ``df`` is read once a pass: pass a written table.

    Nulls are left out, as are doubles that are no finite numbers; a column without values gives no rows.
    Whole numbers come back as decimal(38,0); differences of decimals must fit 38 digits."""
    columns = list(columns)
    kind = _common_type(df, columns)
    floating = kind == "double"
    kind = "decimal(38,0)" if kind == "long" else kind  # differences of longs may exceed longs
    usable = df.select(*[F.col(_q(c)).cast(kind).alias(c) for c in columns])
    if floating:
        finite = [f"CASE WHEN NOT isnan({_q(c)}) AND abs({_q(c)}) < DOUBLE('Infinity') THEN {_q(c)} END AS {_q(c)}" for c in columns]
        usable = usable.selectExpr(*finite)
    bounds = usable.selectExpr(*[f"{f}({_q(c)}) AS `{i}_{f}`" for i, c in enumerate(columns) for f in ("count", "min", "max")]).first()
    found: dict[tuple[str, int], object] = {}
    # a range: column, least and greatest value, rows, rows below it, and its targets' (ordinal, rank)
    ranges = []
    for i, c in enumerate(columns):
        n = bounds[f"{i}_count"]
        ranks = [(j, max(1, -(-n * num // den))) for j, (_, num, den) in enumerate(probs)]
        if n:
            ranges.append((c, bounds[f"{i}_min"], bounds[f"{i}_max"], n, 0, ranks))
    while ranges:
        still = []
        for c, low, high, n, below, ranks in ranges:
            if low == high:
                found.update({(c, j): low for j, _ in ranks})
            else:
                still.append((c, low, high, n, below, ranks))
        ranges, counted = still, _count_ranges(usable, still, kind, floating) if still else {}
        still = []
        for k, (c, _, _, _, below, ranks) in enumerate(ranges):
            held: dict[tuple, tuple] = {}
            for n, low, high in sorted(counted[k], key=lambda r: r[1]):
                inside = [(j, r) for j, r in ranks if below < r <= below + n]
                if inside:
                    held[low, high] = (c, low, high, n, below, inside)
                below += n
            still += held.values()
        ranges = still
    rows = [(c, lbl, j, found[c, j], float(found[c, j])) for c in columns for j, (lbl, _, _) in enumerate(probs) if (c, j) in found]
    return df.sparkSession.createDataFrame(
        rows, f"column_name string, percentile string, ordinal int, exact_value {kind}, value double")


def _count_ranges(usable: DataFrame, ranges: list[tuple], kind: str, floating: bool) -> dict[int, list[tuple]]:
    """(rows, least, greatest) of each filled bin of each range; one scan for all."""
    entries = []
    for k, (c, low, high, n, _, _) in enumerate(ranges):
        x, lo, hi = _q(c), f"CAST('{low!r}' AS {kind})" if floating else f"CAST('{low}' AS {kind})", \
            f"CAST('{high!r}' AS {kind})" if floating else f"CAST('{high}' AS {kind})"
        by = "CAST(NULL AS INT)" if n <= BINS else _bin(x, lo, hi, floating)
        alone = x if n <= BINS else f"CAST(NULL AS {kind})"
        entries.append(f"CASE WHEN {x} BETWEEN {lo} AND {hi} THEN named_struct('k', {k}, 'bin', {by}, 'alone', {alone}, 'x', {x}) END")
    spread = usable.selectExpr(f"inline(filter(array({', '.join(entries)}), e -> e IS NOT NULL))")
    out: dict[int, list[tuple]] = {k: [] for k in range(len(ranges))}
    for r in spread.groupBy("k", "bin", "alone").agg(F.count(F.lit(1)), F.min("x"), F.max("x")).collect():
        out[r[0]].append((r[3], r[4], r[5]))
    return out


def percentiles_approx(df: DataFrame, columns=PERCENTILE_COLUMNS, probs=PERCENTILES,
                       accuracy: int = APPROX_ACCURACY) -> DataFrame:
    """Mergeable-sketch percentiles (``percentile_approx``), one aggregate for all columns."""
    fr = [num / den for _, num, den in probs]
    agg = df.agg(*[F.percentile_approx(F.col(c).cast("double"), fr, accuracy).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(lbl).alias("percentile"), F.lit(i).alias("ordinal"),
                        F.col(c)[i].alias("value"))
               for c in columns for i, (lbl, _, _) in enumerate(probs)]
    return _long(agg, entries)


def approx_rank_check(df: DataFrame, columns=PERCENTILE_COLUMNS, probs=PERCENTILES,
                      accuracy: int = APPROX_ACCURACY) -> DataFrame:
    """(column_name, percentile, ordinal, within_bound): whether the exact rank of each value of
    ``percentiles_approx`` is within rows / accuracy of the rank asked for. One more pass;
    only the (columns x percentiles) approximate values pass through the driver."""
    found = {(r["column_name"], r["percentile"]): r["value"] for r in percentiles_approx(df, columns, probs, accuracy).collect()}
    aggs = [F.count(c).alias(f"{c}__n") for c in columns]
    for c in columns:
        x = F.col(c).cast("double")
        for i, (lbl, _, _) in enumerate(probs):
            v = F.lit(found[(c, lbl)]).cast("double")
            aggs += [F.count_if(x < v).alias(f"{c}__{i}__below"), F.count_if(x <= v).alias(f"{c}__{i}__upto")]
    entries = []
    for c in columns:
        n = F.col(f"{c}__n")
        for i, (lbl, num, den) in enumerate(probs):
            asked, slack = n * num / den, n / accuracy + 1
            ok = (F.col(f"{c}__{i}__below") - slack <= asked) & (asked <= F.col(f"{c}__{i}__upto") + slack)
            entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(lbl).alias("percentile"),
                                    F.lit(i).alias("ordinal"), ok.alias("within_bound")))
    return _long(df.agg(*aggs), entries)


def describe(df: DataFrame, columns=None) -> DataFrame:
    """count, mean, sample stddev, min and max (as text) of every column: one aggregate of the
    numbers, whose buffers are updated in place, and one of the other columns.

    Means of exact numbers are exact, rounded to 4 decimals. A standard deviation, and a mean of
    doubles, is a sum of doubles, whose last digits depend on the order of the rows: it is
    given to 6 significant digits. Text columns have no mean and no stddev."""
    columns = list(columns or df.columns)
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    others = [c for c in columns if c not in numbers]
    parts = [_describe(df, own) for own in (numbers, others) if own]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _describe(df: DataFrame, columns: list[str]) -> DataFrame:
    aggs, entries = [], []
    for c in columns:
        x, kind = _q(c), df.schema[c].dataType
        aggs += [f"count({x}) AS `{c}__n`", f"min({x}) AS `{c}__min`", f"max({x}) AS `{c}__max`"]
        mean, spread = "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            aggs += [f"avg({x}) AS `{c}__s`", f"stddev_samp({x}) AS `{c}__sd`"]
            mean, spread = significant_sql(f"`{c}__s`", 6), significant_sql(f"`{c}__sd`", 6)
        elif isinstance(kind, T.NumericType):
            scale = kind.scale if isinstance(kind, T.DecimalType) else 0
            # a sum of decimals has ten digits more than they; of whole numbers, 19
            total = x if isinstance(kind, T.DecimalType) else f"CAST({x} AS DECIMAL(28,0))"
            aggs += [f"sum({total}) AS `{c}__s`", f"stddev_samp(CAST({x} AS DOUBLE)) AS `{c}__sd`"]
            mean = ratio_half_up_sql(f"`{c}__s`", f"`{c}__n`", 4, scale)
            spread = significant_sql(f"`{c}__sd`", 6)
        entries.append(f"named_struct('column_name', '{c}', 'n', `{c}__n`, 'mean', {mean}, 'stddev', {spread}, "
                       f"'min_value', CAST(`{c}__min` AS STRING), 'max_value', CAST(`{c}__max` AS STRING))")
    return _long_sql(df.selectExpr(*aggs), entries)


def significant_sql(x: str, digits: int) -> str:
    """SQL text: a double with ``digits`` significant digits, as text read back, so engines agree."""
    return f"CAST(format_string('%.{digits - 1}e', {x}) AS DOUBLE)"


def null_counts(df: DataFrame) -> DataFrame:
    agg = df.selectExpr(*[f"count_if({_q(c)} IS NULL) AS {_q(c)}" for c in df.columns])
    return _long_sql(agg, [f"named_struct('column_name', '{c}', 'null_count', {_q(c)})" for c in df.columns])


def null_or_empty_counts(df: DataFrame) -> DataFrame:
    agg = df.selectExpr(*[f"count_if({_q(c)} IS NULL OR CAST({_q(c)} AS STRING) = '') AS {_q(c)}"
                          for c in df.columns])
    return _long_sql(agg, [f"named_struct('column_name', '{c}', 'null_or_empty_count', {_q(c)})"
                           for c in df.columns])


def duplicate_groups(df: DataFrame, keys) -> DataFrame:
    """Key groups seen more than once (groups, not rows), with the rows they hold."""
    return key_duplicates(df, keys).select("*", df.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_rows"))


def _segment(x: Column, lo: Column, hi: Column) -> Column:
    return F.when(x.isNull(), "Unknown").when(x < lo, "Low").when(x < hi, "Medium").otherwise("High")


def quantile_segments(silver: DataFrame, cuts=SEGMENT_CUTS) -> DataFrame:
    """Low / Medium / High from the data's own 33rd / 66th percentiles (a proposed rule).

    The four cut values come from one ``percentiles_exact`` and are compared as constants of
    their own type: no join with the policy rows. ``silver`` is read once a percentile pass:
    pass a written table."""
    found = {(r["column_name"], r["percentile"]): r["exact_value"]
             for r in percentiles_exact(silver, ["premium", "insured_value"], cuts).collect()}

    def cut(column: str, label: str) -> Column:
        return F.lit(found.get((column, label)))
    prem_lo, prem_hi = cut("premium", "p33"), cut("premium", "p66")
    val_lo, val_hi = cut("insured_value", "p33"), cut("insured_value", "p66")
    return silver.select("object_id", "insr_begin", "insr_end",
                         _segment(F.col("premium"), prem_lo, prem_hi).alias("premium_segment_q"),
                         _segment(F.col("insured_value"), val_lo, val_hi).alias("value_segment_q"))


def effective_year(df: DataFrame, column: str = "effective_yr", out: str = "effective_year") -> DataFrame:
    """2-digit code + 2000; a non-numeric code gives null (a proposed rule)."""
    return df.withColumn(out, (F.col(column).try_cast("int") + 2000).cast("int"))


def anomaly_flag(df: DataFrame, column: str, domain, out: str | None = None) -> DataFrame:
    """``<column>_flag``: true when the value is outside ``domain`` (null included)."""
    name = out or f"{column.lower()}_flag"
    return df.withColumn(name, ~F.coalesce(F.col(column).isin(list(domain)), F.lit(False)))


def regex_violations(df: DataFrame, column: str, pattern: str = NUMERIC_CODE) -> DataFrame:
    """Distinct non-null values not matching ``pattern``."""
    return df.select(column).filter(~F.col(column).rlike(pattern)).distinct()
