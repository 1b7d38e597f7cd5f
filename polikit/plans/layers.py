"""Layer builders shared by the registered queries, the bench and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import to_bronze, to_silver
from ..operators.lifecycle import to_gold
from ..operators.staging import stage_table
from ..operators.star import build_star
from ..rules import DEFAULT_RULES, PolicyRules
from ..sources.feed import policy_feed, policy_feed_files

FEED_TABLES = ("lineitem", "orders", "part", "customer")


def bronze_of_files(spark: SparkSession, sf_dir: str, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    """Bronze as the two period files united by name (each file joins its own rows)."""
    return to_bronze(*policy_feed_files(spark, sf_dir, rules.date_format))


def bronze(spark: SparkSession, sf_dir: str, rules: PolicyRules = DEFAULT_RULES, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """The same rows as ``bronze_of_files`` from one pass over the feed; of a ``part`` of the feed, its rows."""
    return to_bronze(policy_feed(spark, sf_dir, rules.date_format, part))


def silver(spark: SparkSession, sf_dir: str, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return to_silver(bronze(spark, sf_dir, rules), rules)


def gold(spark: SparkSession, sf_dir: str, rules: PolicyRules = DEFAULT_RULES) -> DataFrame:
    return to_gold(silver(spark, sf_dir, rules), rules)


#: Written star tables by what they were made from (see ``star``).
_STARS: dict[tuple, dict[str, DataFrame]] = {}


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """(path, bytes, time of change) of every input file: another state, another star."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in FEED_TABLES:
        top = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = top.getFileSystem(conf).listFiles(top, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def star(spark: SparkSession, sf_dir: str, rules: PolicyRules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The star schema over the whole input tables, as written tables in the checkpoint
    folder: gold is written once, the star is built from that. Reports over the same input
    files (their paths, sizes and times of change) share one star, as they share the
    written star tables in the pipeline."""
    key = (spark.sparkContext.applicationId, spark.sparkContext.getCheckpointDir(), rules, _input_state(spark, sf_dir))
    if key not in _STARS:
        written = stage_table(gold(spark, sf_dir, rules), "gold")
        _STARS[key] = {name: stage_table(df, name) for name, df in build_star(written, rules).items()}
    return _STARS[key]


def portable(df: DataFrame) -> DataFrame:
    """Output projection for cross-engine checks: decimal -> double, date -> ISO text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)
