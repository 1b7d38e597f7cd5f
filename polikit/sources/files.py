"""File and JDBC connectors (explicit schemas; no inference pass)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def _typed(text: Column, kind: T.DataType) -> Column:
    """Text as ``kind``; null if it does not parse. Whole numbers may be written as decimals
    (``2007.0``); a fraction is cut off, as a cast of the number would."""
    if isinstance(kind, T.IntegralType):
        return F.trim(text).try_cast("decimal(38,10)").try_cast(kind)
    return text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)


def _read_text(spark: SparkSession, path: str, options: dict | None, keep_corrupt: bool) -> DataFrame:
    """One header CSV (file or folder) with every column as text under its header name."""
    reader = spark.read.option("header", True).options(**(options or {}))
    names = reader.csv(path).columns  # reads the header only
    fields = [T.StructField(n, T.StringType()) for n in names]
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(T.StructType(fields)).csv(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SCHEMA,
             options: dict | None = None, keep_corrupt: bool = False) -> DataFrame:
    """Header CSV read by column NAME, whatever the column order of each path.

    An explicit CSV schema binds columns by position, which silently mis-reads files in
    another order. Here every column is read as text under its header name and cast by
    name to ``schema``. A value that does not parse becomes null (``unparsed_counts``
    counts them); a missing column is an error. A decimal with more places than its
    column is rounded half up. With ``keep_corrupt`` the text of a line with too few or
    too many fields, or with a value that does not parse, is kept in ``_corrupt_record``.
    """
    def one(p: str) -> DataFrame:
        text = _read_text(spark, p, options, keep_corrupt)
        out = [_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields]
        if keep_corrupt:
            lost = reduce(lambda a, b: a | b, [_lost(f) for f in schema.fields])
            line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in text.columns if c != CORRUPT_COLUMN])
            out.append(F.coalesce(F.col(CORRUPT_COLUMN), F.when(lost, line)).alias(CORRUPT_COLUMN))
        return text.select(*out)

    paths = [path] if isinstance(path, str) else list(path)
    return reduce(lambda a, b: a.unionByName(b), map(one, paths))


def _lost(field: T.StructField) -> Column:
    """Whether a text value is there but does not parse as the field's type."""
    text = F.col(f"`{field.name}`")
    return text.isNotNull() & (F.trim(text) != "") & _typed(text, field.dataType).isNull()


def unparsed_counts(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SCHEMA,
                    options: dict | None = None) -> DataFrame:
    """(column_name, unparsed_count): values that ``read_csv`` turns into null, in one pass."""
    paths = [path] if isinstance(path, str) else list(path)
    names = [f.name for f in schema.fields]
    text = reduce(lambda a, b: a.unionByName(b),
                  [_read_text(spark, p, options, False).select(*[f"`{n}`" for n in names]) for p in paths])
    counts = text.agg(*[F.count_if(_lost(f)).alias(f.name) for f in schema.fields])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("unparsed_count")) for n in names])))


def split_csv(spark: SparkSession, path: str | list[str], out: str, schema: T.StructType = RAW_SCHEMA, options: dict | None = None) -> None:
    """Read CSV once and write both its good lines, typed, and its rejected ones under ``out``.

    A line is rejected if it has too few or too many fields, or a value that does not parse as its
    column's type; ``read_split`` reads either kind. Every line goes to one of the two: one
    scan and one write, partitioned by kind, with no shuffle. The text of a line with the wrong
    number of fields is as it was; of other rejected lines it is their fields as CSV."""
    def one(p: str) -> DataFrame:
        text = _read_text(spark, p, options, True)
        names = [c for c in text.columns if c != CORRUPT_COLUMN]
        wrong = F.col(CORRUPT_COLUMN).isNotNull()
        lost = F.filter(F.array(*[F.when(_lost(f), F.lit(f.name)) for f in schema.fields]), lambda c: c.isNotNull())
        reason = F.when(wrong, F.lit("wrong number of fields")).when(
            F.size(lost) > 0, F.concat(F.lit("does not parse: "), F.array_join(lost, ", ")))
        line = F.coalesce(F.col(CORRUPT_COLUMN), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])))
        told = text.select(*[_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields],
                           reason.alias("_reason"), line.alias("_line"), F.col("_metadata.file_path").alias("_file"))
        bad = F.col("_reason").isNotNull()
        return told.select(*[F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields],
                           *[F.when(bad, F.col(c)).alias(c) for c in ("_file", "_reason", "_line")],
                           F.when(bad, "rejected").otherwise("good").alias("_kind"))

    paths = [path] if isinstance(path, str) else list(path)
    both = reduce(lambda a, b: a.unionByName(b), map(one, paths))
    both.write.mode("errorifexists").partitionBy("_kind").parquet(out)


def read_split(spark: SparkSession, out: str, kind: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """The ``good`` rows of ``split_csv``, or the ``rejected`` lines (file, reason, line)."""
    told = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in ("_file", "_reason", "_line", "_kind")]])
    rows = spark.read.schema(told).parquet(out).filter(F.col("_kind") == kind)
    if kind == "good":
        return rows.select(*[f"`{f.name}`" for f in schema.fields])
    return rows.select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_line").alias("line"))


def footer_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows) of written Parquet, from the files' footers: no column is read. What a
    retried task wrote twice is committed once, so these are the rows that are there."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def with_audit(df: DataFrame, column: str) -> DataFrame:
    """Audit timestamp of a layer, added when the layer is written."""
    return df.withColumn(column, F.current_timestamp())


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "overwrite",
               num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """Write a flat table over JDBC with bounded parallelism (``numPartitions``)."""
    w = df.write.mode(mode).format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
