"""Independent DuckDB SQL for every registered query.

Written by hand from the pipeline's rules (not generated from the Spark code) so it
checks the Spark plans. One CTE chain: feed -> bronze -> silver -> gold -> star, then a
final SELECT per key. Averages / ratios use exact integer half-up rounding (HUGEINT),
decimals are cast to DOUBLE and dates to ISO text in outputs, like the Spark side.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (same as the pipeline rules and the feed fixture):
#   reference date 2018-12-31, renewal window 90, premium cuts 756 / 9641,
#   value cuts 730000 / 2000000, old vehicle > 15, high risk >= 2,
#   calendar 2011-01-01 .. 2020-12-31, date text '%d-%b-%y'.
# ---------------------------------------------------------------------------

RAW = ["SEX", "INSR_BEGIN", "INSR_END", "EFFECTIVE_YR", "INSR_TYPE", "INSURED_VALUE", "PREMIUM", "OBJECT_ID",
       "PROD_YEAR", "SEATS_NUM", "CARRYING_CAPACITY", "TYPE_VEHICLE", "CCM_TON", "MAKE", "USAGE", "CLAIM_PAID"]
KEY = ["OBJECT_ID", "INSR_BEGIN", "INSR_END"]
REST = [c for c in RAW if c not in KEY]
SILVER = [c.lower() for c in RAW] + ["policy_duration_days", "vehicle_age", "premium_segment", "value_segment"]
GOLD = SILVER + ["lifecycle_status", "is_active", "is_expired", "renewal_candidate", "risk_score"]
VEH = ["make", "type_vehicle", "ccm_ton", "seats_num", "carrying_capacity", "usage"]
DEC = {"insured_value", "premium", "carrying_capacity", "ccm_ton", "claim_paid"}
DATES = {"insr_begin", "insr_end"}


def rhu(num: str, den: str, digits: int, ns: int = 0, ds: int = 0) -> str:
    """round(num/den, digits) half away from zero, exact, as DOUBLE; NULL if den = 0."""
    a = f"(CAST(({num}) * {10 ** ns} AS HUGEINT) * {10 ** (ds + digits)})"
    b = f"(CAST(({den}) * {10 ** ds} AS HUGEINT) * {10 ** ns})"
    return (f"(CASE WHEN {b} = 0 THEN NULL ELSE CAST(sign({a}) * sign({b}) * ((2 * abs({a}) + abs({b})) "
            f"// (2 * abs({b}))) AS DOUBLE) / {10 ** digits} END)")


def rsum(expr: str, digits: int) -> str:
    return f"CAST(round(SUM({expr}), {digits}) AS DOUBLE)"


def portable(cols, alias: str = "") -> str:
    """Output projection: decimals -> DOUBLE, dates -> ISO text."""
    p = f"{alias}." if alias else ""
    out = []
    for c in cols:
        lc = c.lower()
        if lc in DEC:
            out.append(f"CAST({p}{c} AS DOUBLE) AS {c}")
        elif lc in DATES and c == lc:
            out.append(f"strftime({p}{c}, '%Y-%m-%d') AS {c}")
        else:
            out.append(f"{p}{c}")
    return ", ".join(out)


FMT = "'%d-%b-%y'"
REF = "DATE '2018-12-31'"

CTES: list[tuple[str, str]] = [
    ("src", """
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_linenumber AS ln, l.l_quantity AS qty,
         l.l_extendedprice AS ext, l.l_discount AS disc, l.l_returnflag AS rf, l.l_linestatus AS ls,
         CAST(l.l_shipdate AS DATE) + 6300 AS bd, o.o_custkey AS ck, o.o_totalprice AS tp,
         p.p_type AS ptype, p.p_brand AS brand, p.p_size AS psize, c.c_mktsegment AS seg
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""),
    ("feed", f"""
  SELECT
    CAST(CASE WHEN ok % 1013 = 0 THEN NULL WHEN ok % 1009 = 0 THEN 9 ELSE ck % 3 END AS INTEGER) AS SEX,
    CASE WHEN ok % 2003 = 0 THEN NULL WHEN ok % 2011 = 0 THEN 'N/A' ELSE strftime(bd, {FMT}) END AS INSR_BEGIN,
    CASE WHEN ok % 2003 = 0 THEN NULL
         ELSE strftime(bd + (CASE WHEN ok % 1999 = 0 THEN -30 WHEN ln = 7 THEN 89 ELSE 364 END), {FMT}) END AS INSR_END,
    CASE WHEN pk % 499 = 0 THEN NULL WHEN pk % 501 = 0 THEN '9E' ELSE strftime(bd, '%y') END AS EFFECTIVE_YR,
    CAST(CASE split_part(ptype, ' ', 1) WHEN 'ECONOMY' THEN 1201 WHEN 'SMALL' THEN 1201 WHEN 'MEDIUM' THEN 1202
         WHEN 'PROMO' THEN 1202 WHEN 'STANDARD' THEN 1204 ELSE 1299 END AS INTEGER) AS INSR_TYPE,
    CAST(CASE WHEN qty <= 20 THEN 0 WHEN ok % 997 = 0 THEN -1 ELSE round(tp * 5) END AS DECIMAL(18,2)) AS INSURED_VALUE,
    CASE WHEN ok % 1511 = 0 THEN NULL
         ELSE CAST(CAST(CAST(round(ext * 100) AS BIGINT) * CAST(round(disc * 100) AS BIGINT) AS DECIMAL(18,0))
                   * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) END AS PREMIUM,
    CAST(ok AS BIGINT) AS OBJECT_ID,
    CASE WHEN pk % 97 = 0 THEN NULL ELSE CAST(year(bd) - psize % 25 AS INTEGER) END AS PROD_YEAR,
    CASE WHEN pk % 331 = 0 THEN NULL ELSE CAST(2 + pk % 3 AS INTEGER) END AS SEATS_NUM,
    CASE WHEN pk % 4 = 0 THEN NULL ELSE CAST(1000 AS DECIMAL(18,2)) END AS CARRYING_CAPACITY,
    ptype AS TYPE_VEHICLE,
    CASE WHEN psize = 50 THEN NULL ELSE CAST((psize - psize % 10) * 100 AS DECIMAL(18,2)) END AS CCM_TON,
    brand AS MAKE,
    CASE WHEN pk % 401 = 0 THEN NULL ELSE seg END AS USAGE,
    CASE WHEN rf = 'R' AND ls = 'F' THEN CAST(round(tp) AS DECIMAL(18,2)) END AS CLAIM_PAID,
    bd < DATE '2014-07-01' AS early
  FROM src"""),
    ("bronze", f"SELECT {', '.join(RAW)} FROM feed"),
    ("parsed", f"""
  SELECT * REPLACE (CAST(try_strptime(INSR_BEGIN, {FMT}) AS DATE) AS INSR_BEGIN,
                    CAST(try_strptime(INSR_END, {FMT}) AS DATE) AS INSR_END)
  FROM bronze WHERE SEX IN (0, 1, 2)"""),
    ("cleaned", """
  SELECT * REPLACE (NULLIF(INSURED_VALUE, 0) AS INSURED_VALUE,
                    CAST(COALESCE(CLAIM_PAID, 0) AS DECIMAL(18,2)) AS CLAIM_PAID)
  FROM parsed
  WHERE INSR_BEGIN IS NOT NULL AND INSR_END IS NOT NULL AND INSR_END >= INSR_BEGIN
    AND PREMIUM IS NOT NULL AND PREMIUM > 0"""),
    ("deduped", f"""
  SELECT {', '.join(RAW)} FROM (
    SELECT *, row_number() OVER (PARTITION BY {', '.join(KEY)}
                                 ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in REST)}) AS rn
    FROM cleaned) t
  WHERE rn = 1"""),
    ("silver", f"""
  SELECT {', '.join(f'{c} AS {c.lower()}' for c in RAW)},
         CAST(date_diff('day', INSR_BEGIN, INSR_END) AS INTEGER) AS policy_duration_days,
         CAST(year(INSR_BEGIN) - PROD_YEAR AS INTEGER) AS vehicle_age,
         CASE WHEN PREMIUM < 756 THEN 'low' WHEN PREMIUM < 9641 THEN 'medium' ELSE 'high' END AS premium_segment,
         CASE WHEN INSURED_VALUE IS NULL THEN 'unknown' WHEN INSURED_VALUE < 730000 THEN 'low'
              WHEN INSURED_VALUE < 2000000 THEN 'medium' ELSE 'high' END AS value_segment
  FROM deduped"""),
    ("gold0", f"""
  SELECT *, CASE WHEN insr_begin > {REF} THEN 'future' WHEN insr_end < {REF} THEN 'expired'
                 ELSE 'active' END AS lifecycle_status
  FROM silver"""),
    ("gold", f"""
  SELECT *, lifecycle_status = 'active' AS is_active, lifecycle_status = 'expired' AS is_expired,
         (lifecycle_status = 'expired' AND date_diff('day', insr_end, {REF}) <= 90) AS renewal_candidate,
         CAST(CAST(claim_paid > 0 AS INTEGER) + CAST(insured_value IS NULL AS INTEGER)
              + COALESCE(CAST(vehicle_age > 15 AS INTEGER), 0) AS INTEGER) AS risk_score
  FROM gold0"""),
    ("dim_vehicle", f"""
  SELECT CAST(row_number() OVER (ORDER BY {', '.join(c + ' ASC NULLS LAST' for c in VEH)}) AS INTEGER) AS vehicle_id,
         {', '.join(VEH)}
  FROM (SELECT DISTINCT {', '.join(VEH)} FROM gold) t"""),
    ("dim_insurance_type", """
  SELECT CAST(row_number() OVER (ORDER BY insr_type ASC NULLS LAST) AS INTEGER) AS insurance_type_id,
         insr_type AS insr_type_code,
         CASE insr_type WHEN 1201 THEN 'Third party' WHEN 1202 THEN 'Comprehensive' WHEN 1204 THEN 'Other'
              ELSE 'Unknown' END AS insr_type_name
  FROM (SELECT DISTINCT insr_type FROM gold) t"""),
    ("dim_date", """
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
         strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
         strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(generate_series AS DATE) AS d
        FROM generate_series(TIMESTAMP '2011-01-01', TIMESTAMP '2020-12-31', INTERVAL 1 DAY)) g"""),
    ("fact", f"""
  SELECT CAST(row_number() OVER (ORDER BY p.insr_begin, p.insr_end, p.object_id) AS BIGINT) AS fact_id,
         CAST(p.object_id AS BIGINT) AS object_id, v.vehicle_id, i.insurance_type_id,
         CAST(strftime(p.insr_begin, '%Y%m%d') AS INTEGER) AS insr_begin_id,
         CAST(strftime(p.insr_end, '%Y%m%d') AS INTEGER) AS insr_end_id,
         CAST(p.prod_year AS INTEGER) AS prod_year, CAST(p.sex AS INTEGER) AS sex,
         p.insured_value, p.premium, p.claim_paid,
         CAST(p.policy_duration_days AS INTEGER) AS policy_duration_days,
         CAST(p.vehicle_age AS INTEGER) AS vehicle_age, p.premium_segment, p.value_segment,
         p.lifecycle_status, p.is_active, p.is_expired, p.renewal_candidate, CAST(p.risk_score AS INTEGER) AS risk_score
  FROM gold p
  JOIN dim_vehicle v ON {' AND '.join(f'p.{c} IS NOT DISTINCT FROM v.{c}' for c in VEH)}
  JOIN dim_insurance_type i ON p.insr_type = i.insr_type_code"""),
]
_ORDER = [n for n, _ in CTES]


def with_ctes(upto: str, select: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH <chain up to and including ``upto``> [, extra CTEs] <select>."""
    names = _ORDER[: _ORDER.index(upto) + 1]
    parts = [f"{n} AS ({dict(CTES)[n]}\n)" for n in names] + [f"{n} AS ({q}\n)" for n, q in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + select
