"""Registered queries: tables replaced as a whole, catalog views, resumed runs, footers, split input, sketches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import kpis, profile as PF
from ..operators import sketches as SK
from ..operators.clean import funnel_of_written, to_silver
from ..schemas import RAW_COLUMNS, RAW_SCHEMA
from ..session import ensure_checkpoint_dir
from ..sources import files, published
from ..sources.feed import policy_feed_files
from . import catalog_views, pipeline
from . import layers as L
from . import oracle as O
from .q_layers import kpi_select
from .q_reports import FT, FV
from .registry import ORACLE, register


def _scratch(spark) -> str:
    """A fresh folder next to the checkpoints (the shared folder the cluster names)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}"


@register("mon_footer_funnel", ORACLE["mon_clean_funnel"])
def mon_footer_funnel(spark, sf):
    """The cleaning funnel of written layers: row filters counted in one aggregate, silver by its footers."""
    base = _scratch(spark)
    files.write_parquet(L.bronze(spark, sf), f"{base}/bronze")
    bronze = files.read_parquet(spark, f"{base}/bronze")
    files.write_parquet(to_silver(bronze), f"{base}/silver")
    return funnel_of_written(bronze, files.read_parquet(spark, f"{base}/silver"))


@register("snk_replace_table", O.with_ctes("gold", f"SELECT {O.portable(O.GOLD)} FROM gold"))
def snk_replace_table(spark, sf):
    """Gold published twice under one name, the second time with other rows: the second is read."""
    root = _scratch(spark)
    gold = L.gold(spark, sf)
    published.publish(gold.filter(F.col("risk_score") > 0), root)
    published.publish(gold, root)
    return L.portable(published.read_published(spark, root))


def _catalog(spark, sf) -> str:
    """The star tables and KPI views in a database of their own, registered twice."""
    base, database = _scratch(spark), f"policies_{uuid.uuid4().hex[:12]}"
    star = L.star(spark, sf)
    for version in ("first", "second"):
        paths = {name: f"{base}/{version}/{name}" for name in star}
        for name, path in paths.items():
            rows = star[name].limit(0) if version == "first" else star[name]
            files.write_parquet(rows, path)
        catalog_views.register_tables(spark, paths, database, f"{base}/database")
        catalog_views.register_views(spark, database)
    return database


@register("cat_vw_portfolio_kpis", O.with_ctes("fact", kpi_select("fact", [], kpis.PORTFOLIO)))
def cat_vw_portfolio_kpis(spark, sf):
    return spark.sql(f"SELECT * FROM {_catalog(spark, sf)}.vw_portfolio_kpis")


@register("cat_vw_vehicle_kpis", O.with_ctes("fact", kpi_select(FV, ["make", "type_vehicle"], kpis.VEHICLE)))
def cat_vw_vehicle_kpis(spark, sf):
    return spark.sql(f"SELECT * FROM {_catalog(spark, sf)}.vw_vehicle_kpis")


@register("cat_vw_product_kpis", O.with_ctes("fact", kpi_select(FT, ["insr_type_name"], kpis.PRODUCT)))
def cat_vw_product_kpis(spark, sf):
    return spark.sql(f"SELECT * FROM {_catalog(spark, sf)}.vw_product_kpis")


_LAYERS = {"bronze": "bronze", "silver": "silver", "gold": "gold", **{t: "fact" if t == "fact_policies" else t for t in pipeline.STAR_TABLES}}


@register("st_whole_run", O.with_ctes("fact", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS layer, count(*) AS row_count FROM {cte}" for name, cte in _LAYERS.items())))
def st_whole_run(spark, sf):
    """The whole run from the two period files: rows of each written layer, by footers."""
    res = pipeline.run_pipeline(spark, list(policy_feed_files(spark, sf)), _scratch(spark))
    counts = [files.footer_rows(spark, res.paths[name]).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"))
              .select(F.lit(name).alias("layer"), "row_count") for name in _LAYERS]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("src_csv_split", O.with_ctes("bronze", """
SELECT OBJECT_ID AS object_id,
       CASE WHEN OBJECT_ID % 7 = 0 AND OBJECT_ID % 11 = 0 THEN 'rejected: does not parse: INSR_TYPE, PROD_YEAR'
            WHEN OBJECT_ID % 7 = 0 THEN 'rejected: does not parse: PROD_YEAR'
            WHEN OBJECT_ID % 11 = 0 THEN 'rejected: does not parse: INSR_TYPE' ELSE 'good' END AS kind,
       count(*) AS row_count, CAST(sum(PREMIUM) FILTER (WHERE OBJECT_ID % 7 <> 0 AND OBJECT_ID % 11 <> 0) AS DOUBLE) AS good_premium
FROM bronze GROUP BY 1, 2"""))
def src_csv_split(spark, sf):
    """The feed as CSV with values that do not parse, split into good and rejected lines: all lines by kind."""
    base = _scratch(spark)
    text = L.bronze(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    spoilt = text.withColumns({
        "PROD_YEAR": F.when(F.col("OBJECT_ID").cast("long") % 7 == 0, "n/k").otherwise(F.col("PROD_YEAR")),
        "INSR_TYPE": F.when(F.col("OBJECT_ID").cast("long") % 11 == 0, "?").otherwise(F.col("INSR_TYPE"))})
    files.write_csv(spoilt, f"{base}/raw")
    files.split_csv(spark, f"{base}/raw", f"{base}/split")
    good = files.read_split(spark, f"{base}/split", "good").select(
        F.col("OBJECT_ID").alias("object_id"), F.lit("good").alias("kind"), "PREMIUM")
    fields = F.from_csv("line", F.lit(", ".join(f"`{c}` STRING" for c in RAW_COLUMNS)))
    rejected = files.read_split(spark, f"{base}/split", "rejected").select(
        fields["OBJECT_ID"].cast("long").alias("object_id"), F.concat(F.lit("rejected: "), F.col("reason")).alias("kind"),
        F.lit(None).cast(RAW_SCHEMA["PREMIUM"].dataType).alias("PREMIUM"))
    return good.unionByName(rejected).groupBy("object_id", "kind").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("PREMIUM").cast("double").alias("good_premium"))


@register("prf_sketch_percentiles", ORACLE["prf_percentiles_approx"])
def prf_sketch_percentiles(spark, sf):
    """Percentiles from sketches that were written for each period file by itself and merged: are their
    exact ranks within the bound?"""
    path = _scratch(spark)
    for i, period in enumerate(policy_feed_files(spark, sf)):
        SK.append_sketches(SK.sketch(period, PF.PERCENTILE_COLUMNS, "bronze", F.lit(f"file {i + 1}")), path)
    found = SK.merged_percentiles(spark, path, PF.PERCENTILES, "bronze")
    return SK.rank_check(L.bronze(spark, sf).select(*PF.PERCENTILE_COLUMNS), found, PF.PERCENTILES)
