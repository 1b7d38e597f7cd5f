"""The whole run as one Spark application (ST-7).

raw feed files -> bronze -> DQ -> silver -> DQ -> gold -> DQ -> KPI tables -> star
schema -> KPI views. Each layer is written once (Parquet) and the next layer reads the
written table, so a lost executor never recomputes more than one layer, and every
report reads stable files. Row counts between steps ride on the layer's single write
through ``DataFrame.observe``. A stage that is run again may observe its rows again, so they
are held against the footers of the files written before and after; where these differ the
steps are counted from the written layer (``clean.step_counts``). A manifest records each
finished step with what it was made from: a run that broke off can go on behind its last
finished step (``resume``).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, kpis, quality, reports
from ..operators.lifecycle import to_gold
from ..operators.staging import release_staged, staged_mark
from ..operators.star import build_star
from ..rules import DEFAULT_RULES, PolicyRules
from ..sources import files
from .manifest import Manifest, digest, input_key

STAR_TABLES = ("dim_vehicle", "dim_insurance_type", "dim_date", "fact_policies")

log = logging.getLogger("polikit.pipeline")


@dataclass
class RunResult:
    paths: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)


def _observed(df: DataFrame, name: str, observations: dict[str, Observation]) -> DataFrame:
    obs = Observation(name)
    observations[name] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"))


def silver_with_funnel(bronze: DataFrame, rules: PolicyRules, observations: dict[str, Observation]) -> DataFrame:
    """to_silver with a row-count observation after each cleaning step."""
    df = _observed(bronze, "bronze_in", observations)
    df = _observed(clean.keep_valid_sex(df, rules.sex_domain), "after_sex_filter", observations)
    df = clean.keep_dated(clean.parse_policy_dates(df, rules.date_format))
    df = _observed(df, "after_date_parse", observations)
    df = _observed(clean.keep_ordered_dates(df), "after_date_order", observations)
    df = _observed(clean.keep_positive_premium(df), "after_premium_filter", observations)
    df = clean.fill_zero(clean.zero_to_null(df, "INSURED_VALUE"), "CLAIM_PAID")
    df = _observed(clean.dedup_keep_min(df, rules.policy_key), "after_dedup", observations)
    return clean.snake_case_columns(clean.derive_silver_columns(df, rules))


def write_report(findings: DataFrame, path: str) -> None:
    """Fixed-width text report: header, dashes, one line per finding in suite order.

    ``findings`` comes from ``run_suite(..., with_ordinal=True)``; it holds one row per
    check, so the single output file is bounded by the suite, not by the data."""
    header = quality.report_header()
    spark = findings.sparkSession
    head = spark.createDataFrame([(-2, header), (-1, "-" * len(header))], "ordinal int, line string")
    body = findings.select(F.col("ordinal").cast("int").alias("ordinal"), quality.report_line().alias("line"))
    (head.unionByName(body).coalesce(1).sortWithinPartitions("ordinal").select("line")
     .write.mode("overwrite").text(path))


def _rows(spark: SparkSession, path: str) -> int:
    """Rows of a written layer, by its files' footers."""
    return files.footer_rows(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def reconciled(observed: dict[str, int], bronze: DataFrame, rows_before: int, rows_after: int,
               rules: PolicyRules = DEFAULT_RULES) -> dict[str, int]:
    """The counts of silver's steps: as observed if they begin with the rows of bronze and end with those of silver
    (both by footers), else counted anew."""
    if observed.get("bronze_in") == rows_before and observed.get("after_dedup") == rows_after:
        return observed
    log.warning("observed counts %s do not fit %d rows of bronze and %d of silver: counted anew", observed, rows_before, rows_after)
    counted = clean.step_counts(bronze, rules).first().asDict()
    return {"bronze_in": counted.pop("bronze_rows"), **counted, "after_dedup": rows_after}


def run_pipeline(spark: SparkSession, feed_files: list[DataFrame], out_dir: str,
                 rules: PolicyRules = DEFAULT_RULES, jdbc: dict | None = None,
                 ordered_fact_ids: bool = True, partition_fact_by_year: bool = False,
                 fact_partitions: int | None = None, vehicle_partitions: int | None = None,
                 resume: bool = False) -> RunResult:
    """Run every stage. ``jdbc`` (optional: url, table, properties, num_partitions) also
    stages the gold table into a database, as the reference's BI path does.
    ``ordered_fact_ids=False`` numbers the fact in storage order of the written gold
    table (no shuffle of the fact; see ``star.fact_policies``). ``partition_fact_by_year``
    writes the fact partitioned by ``begin_year`` (begin-date year), so year slicers
    prune whole directories. ``fact_partitions`` and ``vehicle_partitions`` set over how many
    partitions ids are dealt (default: by row count). Intermediate tables are deleted at the end.
    With ``resume`` the steps that the manifest in ``out_dir`` records as finished, from the same
    input files, rules and options, are skipped, up to the first that is not."""
    mark = staged_mark()
    out_dir = out_dir.rstrip("/")
    res = RunResult()
    record = Manifest(spark, out_dir, resume)
    key = digest(input_key(feed_files), rules)

    def step(name: str, outputs: list[str], make, *options) -> None:
        """Make a step's outputs, unless they are there. ``make`` takes their paths and returns counts."""
        nonlocal key
        key = digest(key, name, options)
        paths = [f"{out_dir}/{o}" for o in outputs]
        res.paths.update(zip(outputs, paths, strict=True))
        if not record.fresh(name, key, paths):
            record.finish(name, key, paths, make(*paths) or {})
        res.counts.update(record.steps[name]["counts"])

    def layer(name: str) -> DataFrame:
        return files.read_parquet(spark, res.paths[name])

    def checks(name: str, suite, only: list[str] | None = None) -> None:
        def make(findings_path: str, report_path: str) -> None:
            df = layer(name) if only is None else layer(name).select(*only)
            files.write_parquet(quality.run_suite(df, suite(df, rules), with_ordinal=True), findings_path)
            write_report(files.read_parquet(spark, findings_path), report_path)
        step(f"dq_{name}", [f"dq_{name}", f"dq_{name}_report"], make)

    def make_bronze(path: str) -> dict[str, int]:
        files.write_parquet(files.with_audit(clean.to_bronze(*feed_files), "bronze_processed_at"), path)
        return {"bronze": _rows(spark, path)}

    def make_silver(path: str) -> dict[str, int]:
        obs: dict[str, Observation] = {}
        bronze = layer("bronze")
        files.write_parquet(files.with_audit(silver_with_funnel(bronze, rules, obs), "silver_processed_at"), path)
        seen = {name: int(o.get.get("rows", 0)) for name, o in obs.items()}
        rows = _rows(spark, path)
        return {**reconciled(seen, bronze, res.counts["bronze"], rows, rules), "silver": rows}

    def make_gold(path: str) -> dict[str, int]:
        files.write_parquet(files.with_audit(to_gold(layer("silver"), rules), "gold_processed_at"), path)
        return {"gold": _rows(spark, path)}

    def make_kpis(portfolio: str, vehicle: str, product: str) -> None:
        # no sort before a Parquet write: row order on read is not a contract
        files.write_parquet(kpis.portfolio_kpis(layer("gold"), rules), portfolio)
        files.write_parquet(kpis.vehicle_kpis(layer("gold"), rules), vehicle)
        files.write_parquet(kpis.product_kpis(layer("gold"), rules), product)

    def make_star(*paths: str) -> None:
        star = build_star(layer("gold"), rules, ordered_fact_ids, fact_partitions, vehicle_partitions)
        for name, path in zip(STAR_TABLES, paths, strict=True):
            by_year = name == "fact_policies" and partition_fact_by_year
            df = star[name].withColumn("begin_year", (F.col("insr_begin_id") / 10000).cast("int")) if by_year else star[name]
            files.write_parquet(df, path, partition_by=["begin_year"] if by_year else None)

    step("bronze", ["bronze"], make_bronze)
    checks("bronze", quality.bronze_suite)
    step("silver", ["silver"], make_silver)
    checks("silver", quality.silver_suite)
    step("gold", ["gold"], make_gold)
    checks("gold", quality.gold_suite, quality.GOLD_CHECK_COLUMNS)
    if jdbc:
        step("jdbc", [], lambda: files.write_jdbc(
            layer("gold"), jdbc["url"], jdbc.get("table", "policies_lifecycle"), jdbc.get("properties"),
            num_partitions=jdbc.get("num_partitions")), jdbc["url"], jdbc.get("table"))
    step("kpis", ["kpi_portfolio", "kpi_vehicle", "kpi_product"], make_kpis)
    step("star", list(STAR_TABLES), make_star, ordered_fact_ids, partition_fact_by_year)
    release_staged(spark, mark)
    register_views({name: layer(name) for name in STAR_TABLES}, rules)
    res.skipped = record.skipped
    log.info("row counts: %s", res.counts)
    return res


def register_views(star: dict[str, DataFrame], rules: PolicyRules = DEFAULT_RULES) -> None:
    """Star tables and the three KPI views as temp views (create-or-replace, re-runnable)."""
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    reports.vw_portfolio_kpis(star, rules).createOrReplaceTempView("vw_portfolio_kpis")
    reports.vw_vehicle_kpis(star, rules).createOrReplaceTempView("vw_vehicle_kpis")
    reports.vw_product_kpis(star, rules).createOrReplaceTempView("vw_product_kpis")
