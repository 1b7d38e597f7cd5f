"""Input paths that must not lose data: null dates, other column orders, numbers as text."""

import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from polikit.operators.clean import to_bronze
from polikit.plans import layers as L
from polikit.schemas import RAW_COLUMNS
from polikit.sources import files
from polikit.sources.feed import policy_feed, policy_feed_files


def _feed_folder(spark, scratch, lineitem):
    for name in ("orders", "part", "customer"):
        shutil.copyfile(f"{SMOKE}/{name}.parquet", f"{scratch}/{name}.parquet")
    lineitem.write.mode("overwrite").parquet(f"{scratch}/lineitem.parquet")
    return scratch


def test_rows_without_ship_date_or_parent_stay(spark, scratch):
    li = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    li = li.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_shipdate")))
    li = li.withColumn("l_partkey", F.when(F.col("l_linenumber") != 3, F.col("l_partkey")))
    folder = _feed_folder(spark, scratch, li)
    first, second = policy_feed_files(spark, folder)
    n = li.count()
    assert li.filter("l_shipdate is null").count() > 100
    assert first.count() + second.count() == n == policy_feed(spark, folder).count()
    both, once = to_bronze(first, second), to_bronze(policy_feed(spark, folder))
    assert both.exceptAll(once).count() == 0 and once.exceptAll(both).count() == 0


LINE = {"SEX": "1.0", "INSR_BEGIN": "01-JAN-15", "INSR_END": "31-DEC-15", "EFFECTIVE_YR": "15", "INSR_TYPE": "1201",
        "INSURED_VALUE": "100.005", "PREMIUM": "10", "OBJECT_ID": "7", "PROD_YEAR": "2007.0", "SEATS_NUM": "4.0",
        "CARRYING_CAPACITY": "1000", "TYPE_VEHICLE": "Pick-up", "CCM_TON": "x", "MAKE": "TOYOTA", "USAGE": "Private",
        "CLAIM_PAID": ""}


def _write(path, names, rows):
    with open(path, "w") as fh:
        fh.write(",".join(names) + "\n" + "".join(",".join(r[n] for n in names) + "\n" for r in rows))


def test_numbers_written_as_decimals_and_unparsed_values_counted(spark, scratch):
    _write(f"{scratch}/a.csv", RAW_COLUMNS, [LINE, LINE | {"PROD_YEAR": "2008.9", "SEX": "male"}])
    rows = files.read_csv(spark, f"{scratch}/a.csv").orderBy("PROD_YEAR").collect()
    assert [(r["PROD_YEAR"], r["SEATS_NUM"], r["SEX"]) for r in rows] == [(2007, 4, 1), (2008, 4, None)]
    assert rows[0]["INSURED_VALUE"] == Decimal("100.01") and rows[0]["CLAIM_PAID"] is None and rows[0]["CCM_TON"] is None
    lost = {r[0]: r[1] for r in files.unparsed_counts(spark, f"{scratch}/a.csv").collect()}
    assert {k: v for k, v in lost.items() if v} == {"SEX": 1, "CCM_TON": 2} and len(lost) == 16


def test_paths_with_other_column_orders_are_read_by_name(spark, scratch):
    _write(f"{scratch}/a.csv", RAW_COLUMNS, [LINE])
    _write(f"{scratch}/b.csv", RAW_COLUMNS[::-1], [LINE | {"OBJECT_ID": "8"}])
    rows = files.read_csv(spark, [f"{scratch}/a.csv", f"{scratch}/b.csv"]).orderBy("OBJECT_ID").collect()
    assert [r["OBJECT_ID"] for r in rows] == [7, 8]
    assert {r["MAKE"] for r in rows} == {"TOYOTA"} and {r["SEX"] for r in rows} == {1}
    _write(f"{scratch}/c.csv", RAW_COLUMNS[1:], [LINE])
    with pytest.raises(Exception, match="SEX"):
        files.read_csv(spark, f"{scratch}/c.csv").collect()


def test_changed_input_under_the_same_path_gives_a_new_star(spark, scratch):
    li = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    folder = _feed_folder(spark, scratch, li)
    before = L.star(spark, folder)["fact_policies"].count()
    assert L.star(spark, folder) is L.star(spark, folder)
    _feed_folder(spark, folder, spark.read.parquet(f"{SMOKE}/lineitem.parquet").filter("l_orderkey % 5 = 0"))
    after = L.star(spark, folder)["fact_policies"].count()
    assert 0 < after < before / 2
