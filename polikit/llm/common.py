"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A side is broadcast only if it has been counted and has at most this many rows.
BROADCAST_ROWS = 200_000

#: Folders written by ``stage`` in this process, for ``clear_staged``.
_STAGED: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back: lineage is
    cut, and a lost executor costs a re-read, not a re-run."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> int:
    """Delete every folder ``stage`` has written in this process; call it once the results
    that read them have been written. Returns how many there were."""
    jvm, n = spark.sparkContext._jvm, len(_STAGED)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


#: What the operator that now uses this Python worker keeps between its tasks.
_KEPT: dict = {}


def kept_in_worker(key=None, make=None):
    """The object that this Python worker keeps under ``key``, made if it is not there. A worker
    is used again by later stages, so it keeps one operator's memory only: asking for another
    key, or for none, lets the last one go."""
    if key not in _KEPT:
        _KEPT.clear()
        if key is not None:
            _KEPT[key] = make()
    return _KEPT.get(key)


#: Bytes of a batch of rows on its way to Python and back; Spark's own bound is eight times that.
BATCH_BYTES = "8m"
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Send whole texts to Python in smaller batches, unless the session sets their size: a batch is held by
    the JVM, the pipe and Python at once, for each task of an executor."""
    if spark.conf.get(_BATCH_CONF, None) == "67108864b":  # the default
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)


def broadcast_if_small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only for a side counted to be at most ``limit`` rows (``rows``: its
    count if known); a larger one is left to a shuffle join, with the same result."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df
