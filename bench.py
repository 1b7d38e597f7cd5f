"""Benchmark: the whole policy pipeline and its reports at one scale factor.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1) and prints
ONE JSON line: {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.

An untimed warm-up pass over a small fixture (sf0.01) comes first (steady-state timing).
Layers are timed as the pipeline runs them (each written once, the next reads the
written table); reports, KPIs, DQ suites and profiles are timed over the written
layers. Each timed query runs to completion through the no-op sink (full execution,
nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from polikit.operators import kpis, profile, quality, reports  # noqa: E402
from polikit.operators.clean import funnel_of_written, to_bronze, to_silver  # noqa: E402
from polikit.operators.lifecycle import to_gold  # noqa: E402
from polikit.operators.star import build_star  # noqa: E402
from polikit.session import local_session  # noqa: E402
from polikit.sources import files  # noqa: E402
from polikit.sources.feed import policy_feed  # noqa: E402


def run_all(spark, sf_dir: str, out: str, times: dict[str, float] | None) -> None:
    """Every timed step; with ``times=None`` it is an untimed warm-up pass."""
    def timed(name, fn):
        t0 = time.perf_counter()
        r = fn()
        if times is not None:
            times[name] = round(time.perf_counter() - t0, 3)
        return r

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    timed("bronze", lambda: files.write_parquet(to_bronze(policy_feed(spark, sf_dir)), f"{out}/bronze"))
    bronze = spark.read.parquet(f"{out}/bronze")
    timed("silver", lambda: files.write_parquet(to_silver(bronze), f"{out}/silver"))
    silver = spark.read.parquet(f"{out}/silver")
    timed("gold", lambda: files.write_parquet(to_gold(silver), f"{out}/gold"))
    gold = spark.read.parquet(f"{out}/gold")

    def star_write():
        for name, df in build_star(gold).items():
            files.write_parquet(df, f"{out}/{name}")
    timed("star", star_write)
    star = {n: spark.read.parquet(f"{out}/{n}")
            for n in ("dim_vehicle", "dim_insurance_type", "dim_date", "fact_policies")}

    queries = {
        "mon_clean_funnel": lambda: funnel_of_written(bronze, silver),
        "kpi_portfolio": lambda: kpis.portfolio_kpis(gold),
        "kpi_vehicle": lambda: kpis.vehicle_kpis(gold),
        "kpi_product": lambda: kpis.product_kpis(gold),
        "vw_vehicle_kpis": lambda: reports.vw_vehicle_kpis(star),
        "q01_portfolio": lambda: reports.q01_portfolio(star),
        "q02_by_year": lambda: reports.q02_by_year(star),
        "q03_top_makes": lambda: reports.q03_top_makes(star),
        "q04_products": lambda: reports.q04_products(star),
        "q05_renewals": lambda: reports.q05_renewals(star),
        "q06_risk_distribution": lambda: reports.q06_risk_distribution(star),
        "q07_segment_mix": lambda: reports.q07_segment_mix(star),
        "q08_monthly": lambda: reports.q08_monthly(star),
        "q09_high_risk": lambda: reports.q09_high_risk(star),
        "q10_claim_rate": lambda: reports.q10_claim_rate(star),
        "dq_bronze": lambda: quality.dq_bronze(bronze),
        "dq_silver": lambda: quality.dq_silver(silver),
        "dq_gold": lambda: quality.dq_gold(gold),
        "dq_foreign_keys": lambda: quality.foreign_key_findings(
            star["fact_policies"], "fact_policies",
            [("vehicle_id", star["dim_vehicle"], "vehicle_id", "dim_vehicle"),
             ("insurance_type_id", star["dim_insurance_type"], "insurance_type_id", "dim_insurance_type"),
             ("insr_begin_id", star["dim_date"], "date_id", "dim_date"),
             ("insr_end_id", star["dim_date"], "date_id", "dim_date")], broadcast_parents=("dim_date",)),
        "dq_profile_findings": lambda: quality.eda_findings(bronze),
        "prf_value_counts": lambda: profile.value_counts(bronze),
        "prf_describe": lambda: profile.describe(bronze),
        "prf_percentiles_exact": lambda: profile.percentiles_exact(bronze),
        "prf_percentiles_approx": lambda: profile.percentiles_approx(bronze),
    }
    for name, build in queries.items():
        timed(name, lambda b=build: run(b()))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="polikit-bench", driver_memory="16g")
    # Steady state: one untimed pass over a small fixture loads classes and JIT-compiles
    # the same generated code (a first query otherwise pays ~8 s of JVM warm-up, and a
    # 6k-row pass is too short for the JIT to compile the hot loops).
    if os.path.isdir(warm_dir):
        run_all(spark, warm_dir, tempfile.mkdtemp(prefix="polikit-warm-", dir="/tmp"), None)
    times: dict[str, float] = {}
    run_all(spark, sf_dir, tempfile.mkdtemp(prefix="polikit-bench-", dir="/tmp"), times)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
