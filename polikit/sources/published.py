"""Tables that are replaced as a whole: readers see the old rows or the new ones, never half a table.

A published table is a folder of versions and a pointer file. A new version is written
beside the others; only when its write has been committed does the pointer move to it, by
one rename over the old pointer. A write that fails leaves the pointer alone, and its remains go
with the next publication. Readers resolve the pointer once and then read that version, which
stays until ``keep`` newer ones exist.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_CURRENT"


def _hadoop(spark: SparkSession, path: str):
    """(path constructor, file system, configuration) of a path."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    make = jvm.org.apache.hadoop.fs.Path
    return make, make(path).getFileSystem(conf), conf


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in place by one rename over what was there."""
    make, fs, conf = _hadoop(spark, path)
    beside = f"{path}.{uuid.uuid4().hex}"
    out = fs.create(make(beside), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    over = gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    target = fs.makeQualified(make(path))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(fs.makeQualified(make(beside)), target, over)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None if there is none."""
    make, fs, _ = _hadoop(spark, path)
    if not fs.exists(make(path)):
        return None
    stream = fs.open(make(path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def folders(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Names of the folders in ``root``."""
    make, fs, _ = _hadoop(spark, root)
    if not fs.exists(make(root)):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(make(root)) if s.isDirectory()]
    return sorted(n for n in found if n.startswith(prefix))


def remove(spark: SparkSession, path: str) -> None:
    make, fs, _ = _hadoop(spark, path)
    fs.delete(make(path), True)


def current_path(spark: SparkSession, root: str) -> str:
    """The folder of the published version."""
    name = read_text(spark, f"{root.rstrip('/')}/{POINTER}")
    if name is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return f"{root.rstrip('/')}/{name.strip()}"


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None, keep: int = 2) -> str:
    """Write ``df`` as the table's new version and make it the published one. ``df`` may read the table.
    Returns the version's folder. One writer at a time."""
    spark, root = df.sparkSession, root.rstrip("/")
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{name}")
    before = read_text(spark, f"{root}/{POINTER}")
    write_text(spark, f"{root}/{POINTER}", name)
    others = [v for v in folders(spark, root, "v-") if v != name]
    kept = [v for v in others if before is not None and v <= before.strip()][-(keep - 1):] if keep > 1 else []
    for v in others:
        if v not in kept:  # old versions, and remains of writes that failed
            remove(spark, f"{root}/{v}")
    return f"{root}/{name}"


def read_published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, root))
