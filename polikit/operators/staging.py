"""Intermediate tables in the shared checkpoint folder, with an explicit clean-up."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Folders that ``stage_table`` has written in this process and nobody has released.
_STAGED: list[str] = []


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back
    (cuts lineage; the next reads see exactly the written rows, also after a lost executor)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_mark() -> int:
    """A mark to give to ``release_staged``: what is staged from here on."""
    return len(_STAGED)


def release_staged(spark: SparkSession, mark: int = 0) -> int:
    """Delete the tables staged since ``mark``, once what was made from them is written.
    Returns how many there were."""
    own = _STAGED[mark:]
    del _STAGED[mark:]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in map(jvm.org.apache.hadoop.fs.Path, own):
        path.getFileSystem(conf).delete(path, True)
    return len(own)


_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, an action's shuffle files are deleted when it ends, not when the driver's garbage collection finds them.
    For DataFrames with one action each: another would have to make its shuffles anew. Files that tasks wrote after
    their action had ended (a side of a join that was not needed) go with a collection at its end."""
    before = spark.conf.get(_DROP, None)
    spark.conf.set(_DROP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP) if before is None else spark.conf.set(_DROP, before)
        gc.collect()  # Python's handles first
        spark.sparkContext._jvm.System.gc()


#: A side is broadcast only if it has been counted and has at most this many (narrow) rows.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a side counted to be small; a larger one is left to a shuffle join."""
    return F.broadcast(df) if df.count() <= limit else df
