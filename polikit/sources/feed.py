"""The raw policy feed, derived from the TPC-H-like driver tables.

One raw policy per ``lineitem`` row with its order, part and customer (left joins: a
row without one of them stays, with nulls).
Every value is an integer/decimal function of the inputs, so any engine computes
the same rows. Dirty values (null/unknown SEX, unparseable dates, zero/negative
money, repeated keys) are injected by fixed rules so every cleaning branch is hit.
No row is dropped: the feed grows exactly with ``lineitem``.

Scale: lineitem (largest) joins part while its rows are narrow, customer joins orders, and
the two meet on the order key last. Rows then lie by OBJECT_ID, the leading part of the
policy key, so what groups by that key needs no third shuffle of the widened rows. A large
feed is dealt over as many partitions as it has rows for (``ROWS_PER_PARTITION``), so a task's
memory does not follow the input; the rows of one order key are one task's. The joins
before are left to AQE, which broadcasts a side at runtime only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and splits skewed keys. A large feed can also be made in ``parts`` of whole
order keys, one after another, so what must lie on disk at a time (the shuffled rows) is a part's; each part
reads the tables once more, which costs little beside the joins.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONEY, PREMIUM, RAW_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values of the feed (fixture rules, shared with the SQL oracle):
#   begin date = ship date + 6300 days
#   term: -30 days if orderkey % 1999 = 0, else 89 if linenumber = 7, else 364
#   SEX: null if orderkey % 1013 = 0, 9 if orderkey % 1009 = 0, else custkey % 3
#   INSR_BEGIN: null if orderkey % 2003 = 0, 'N/A' if orderkey % 2011 = 0
#   INSR_END: null if orderkey % 2003 = 0
#   EFFECTIVE_YR: null if partkey % 499 = 0, '9E' if partkey % 501 = 0, else yy of begin
#   INSR_TYPE by first word of p_type: ECONOMY, SMALL 1201; MEDIUM, PROMO 1202;
#             STANDARD 1204; else 1299
#   INSURED_VALUE: 0 if quantity <= 20, -1 if orderkey % 997 = 0, else round(totalprice * 5)
#   PREMIUM: null if orderkey % 1511 = 0, else round(extprice*100) * round(discount*100) / 10000
#   PROD_YEAR: null if partkey % 97 = 0, else year(begin) - p_size % 25
#   SEATS_NUM: null if partkey % 331 = 0, else 2 + partkey % 3
#   CARRYING_CAPACITY: null if partkey % 4 = 0, else 1000
#   CCM_TON: null if p_size = 50, else (p_size - p_size % 10) * 100
#   USAGE: null if partkey % 401 = 0, else c_mktsegment
#   CLAIM_PAID: round(totalprice) if returnflag = 'R' and linestatus = 'F', else null
#   period split for the two feed files: begin date < 2014-07-01
# ---------------------------------------------------------------------------
SHIFT_DAYS = 6300
PERIOD_SPLIT = _dt.date(2014, 7, 1)
TYPE_CODES = (("ECONOMY", 1201), ("SMALL", 1201), ("MEDIUM", 1202), ("PROMO", 1202), ("STANDARD", 1204))
OTHER_TYPE_CODE = 1299

#: Feed rows that a task is meant to join and group; a feed of at most ``LEAST_ROWS`` is left to Spark's own partitions.
ROWS_PER_PARTITION = 250_000
LEAST_ROWS = 5_000_000
#: Parts of a large feed, of about so many rows, but no more parts than that.
PART_ROWS = 2_500_000
MOST_PARTS = 8


def _fmt(d: Column, fmt: str) -> Column:
    return F.date_format(d, fmt)


def _type_code(p_type: Column) -> Column:
    head = F.substring_index(p_type, " ", 1)
    expr = None
    for word, code in TYPE_CODES:
        expr = F.when(head == word, code) if expr is None else expr.when(head == word, code)
    return expr.otherwise(OTHER_TYPE_CODE)


def parts(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """The parts (number, of how many) that a feed is made in: one, or several if it is large."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # from the files' footers
    n = 1 if rows <= LEAST_ROWS else min(MOST_PARTS, -(-rows // PART_ROWS))
    return [(i, n) for i in range(n)]


def in_part(key: Column, part: tuple[int, int]) -> Column:
    """Whether an order key is in a part; all rows of a key (or of none) are in one."""
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(part[1])) == part[0]


def feed_with_period(spark: SparkSession, sf_dir: str, date_format: str = "dd-MMM-yy",
                     part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Feed rows plus a ``_early`` flag (first / second period file); of a ``part``, its rows."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    pt = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type", "p_brand", "p_size")
    cu = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    # customer is joined onto orders (4x fewer rows than lineitem) first, so without
    # broadcasts the lineitem-width stream is shuffled twice (part key, order key), not 3x.
    if part[1] > 1:
        od = od.filter(in_part(F.col("o_orderkey"), part))
    oc = od.join(cu, od.o_custkey == cu.c_custkey, "left")
    own = li.filter(in_part(F.col("l_orderkey"), part)) if part[1] > 1 else li
    lp = own.join(pt, own.l_partkey == pt.p_partkey, "left")
    rows = li.count() // part[1]  # from the files' footers
    if rows > LEAST_ROWS:
        n = -(-rows // ROWS_PER_PARTITION)
        lp, oc = lp.repartition(n, "l_orderkey"), oc.repartition(n, "o_orderkey")
    j = lp.join(oc, lp.l_orderkey == oc.o_orderkey, "left")

    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    bd = F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS)
    term = F.when(ok % 1999 == 0, -30).when(F.col("l_linenumber") == 7, 89).otherwise(364)
    size = F.col("p_size")
    premium = ((F.round(F.col("l_extendedprice") * 100).cast("long")
                * F.round(F.col("l_discount") * 100).cast("long")).cast("decimal(18,0)")
               * F.lit(Decimal("0.0001")).cast("decimal(5,4)")).cast(PREMIUM)
    cols = {
        "SEX": F.when(ok % 1013 == 0, F.lit(None)).when(ok % 1009 == 0, 9)
        .otherwise((F.col("o_custkey") % 3).cast("int")).cast("int"),
        "INSR_BEGIN": F.when(ok % 2003 == 0, F.lit(None)).when(ok % 2011 == 0, "N/A")
        .otherwise(_fmt(bd, date_format)),
        "INSR_END": F.when(ok % 2003 == 0, F.lit(None)).otherwise(_fmt(F.date_add(bd, term), date_format)),
        "EFFECTIVE_YR": F.when(pk % 499 == 0, F.lit(None)).when(pk % 501 == 0, "9E").otherwise(_fmt(bd, "yy")),
        "INSR_TYPE": _type_code(F.col("p_type")).cast("int"),
        "INSURED_VALUE": F.when(F.col("l_quantity") <= 20, 0).when(ok % 997 == 0, -1)
        .otherwise(F.round(F.col("o_totalprice") * 5)).cast(MONEY),
        "PREMIUM": F.when(ok % 1511 == 0, F.lit(None).cast(PREMIUM)).otherwise(premium),
        "OBJECT_ID": ok.cast("long"),
        "PROD_YEAR": F.when(pk % 97 == 0, F.lit(None)).otherwise(F.year(bd) - size % 25).cast("int"),
        "SEATS_NUM": F.when(pk % 331 == 0, F.lit(None)).otherwise(2 + (pk % 3).cast("int")).cast("int"),
        "CARRYING_CAPACITY": F.when(pk % 4 == 0, F.lit(None)).otherwise(F.lit(1000)).cast(MONEY),
        "TYPE_VEHICLE": F.col("p_type"),
        "CCM_TON": F.when(size == 50, F.lit(None)).otherwise((size - size % 10) * 100).cast(MONEY),
        "MAKE": F.col("p_brand"),
        "USAGE": F.when(pk % 401 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")),
        "CLAIM_PAID": F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
                             F.round(F.col("o_totalprice"))).cast(MONEY),
    }
    return j.select(*[c.alias(n) for n, c in cols.items()], (bd < F.lit(PERIOD_SPLIT)).alias("_early"),
                    "l_shipdate")


def policy_feed(spark: SparkSession, sf_dir: str, date_format: str = "dd-MMM-yy",
                part: tuple[int, int] = (0, 1)) -> DataFrame:
    """The whole raw feed (16 columns, raw schema), or a ``part`` of it."""
    return feed_with_period(spark, sf_dir, date_format, part).select(*RAW_COLUMNS)


def policy_feed_files(spark: SparkSession, sf_dir: str, date_format: str = "dd-MMM-yy") -> tuple[DataFrame, DataFrame]:
    """The feed as two period 'files'; the second has its columns in reverse order
    (so only a by-name union assembles them correctly).

    The period test ``ship date + shift < split`` is applied as an equivalent bound on
    the raw ``l_shipdate`` column, so it reaches the Parquet scan (row-group pruning)
    and each file joins only its own rows. A row without a ship date is in the second."""
    f = feed_with_period(spark, sf_dir, date_format)
    ship = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema["l_shipdate"].dataType
    bound = F.lit(f"{PERIOD_SPLIT - _dt.timedelta(days=SHIFT_DAYS)} 00:00:00").cast(ship)
    early = F.col("l_shipdate") < bound
    first = f.filter(early).select(*RAW_COLUMNS)
    second = f.filter(~early | F.col("l_shipdate").isNull()).select(*reversed(RAW_COLUMNS))
    return first, second
