"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments: of two fingerprints at
most ``max_bits`` apart, at least one segment then differs in at most one bit. Each
fingerprint is indexed under the *one-wildcard variants* of its segments (the segment
with one bit deleted, with its place); equality of variants brings together all pairs
that can be near, and the bit distance verifies them. For two bits the last segment needs
no wildcard: if the other one differs in two bits, it differs in none.

Scale: equal fingerprints collapse first (map-side combine), so thousands of copies are
one index entry. A bucket is counted before its members are gathered. Buckets of up to
``bucket_cap`` members give verified pairs. In a larger one (a big group of near copies)
pairs would grow with the square of the group, so its members are linked by
*midpoints* instead: two fingerprints are at most 2 apart exactly if some 64-bit value
is at most 1 away from both. Grouping each member's 65 such values gives groups of at
most 65 members, all truly linked, with no pairs to verify: the exact way for the rest.
Components come from alternating large-star/small-star rounds over staged edge tables.

Null or word-free texts have fingerprint 0 and are linked like any other. A null id gets a
fingerprint and a component, but cannot name one (the component of null ids alone is null).
Repeated rows stay. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, broadcast_if_small, stage

SEED = 42
_BLOCK = 16_384  # shingle hashes whose bits are counted at once


def simhash(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint: bit b is set if over half of the shingles' XXH64 have it.
    Words are split at ASCII white space and A-Z are lower-cased (both as ``bytes`` does)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _BLOCK):
        block = hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id_col, fp): the signed 64-bit form of each row's fingerprint."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp). max_bits 1: the one segment, all 64 bits, under each of its one-wildcard variants.
    2: the 32 one-wildcard variants of the low half, and the high half as it is: where the low
    halves differ in two bits, the high ones are equal. The key holds the variant's place above
    the bits that are left."""
    if max_bits == 1:
        return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v")).select(
            F.expr("struct(v, fp & ~shiftleft(1L, v))").alias("key"), "fp")
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("v")).select(F.expr(
        "CASE WHEN v = 32 THEN shiftrightunsigned(fp, 32) ELSE fp & 4294967295L & ~shiftleft(1L, v) END"
        " | shiftleft(cast(v AS long), 32)").alias("key"), "fp")


def links(fps: DataFrame, max_bits: int = 2, bucket_cap: int = 64) -> DataFrame:
    """Edges (a, b), a != b, that connect exactly the fingerprints connected by steps of at most
    ``max_bits`` (0 to 2). ``fps``: distinct fingerprints in a column ``fp``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= max_bits
    keys = _variants(fps, max_bits)
    buckets = stage(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                    .filter("n > 1"), "buckets")
    twos = buckets.filter("n = 2").filter(near(F.col("a"), F.col("b"))).select("a", "b")
    full = keys.join(broadcast_if_small(buckets.filter("n > 2").select("key", "n")), "key")
    pair = F.filter(
        F.flatten(F.transform("fps", lambda x, i: F.transform(
            F.slice("fps", i + 2, F.size("fps")), lambda y: F.struct(x.alias("a"), y.alias("b"))))),
        lambda p: near(p["a"], p["b"]))
    some = (full.filter(f"n <= {bucket_cap}").groupBy("key").agg(F.collect_list("fp").alias("fps"))
            .select(F.explode(pair).alias("p")).select("p.a", "p.b"))
    hot = full.filter(f"n > {bucket_cap}").select("fp").distinct()
    middles = hot.select("fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("v")).select(
        F.expr("CASE WHEN v < 0 THEN fp ELSE fp ^ shiftleft(1L, v) END").alias("z"), "fp")
    stars = (middles.groupBy("z").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps"))
             .filter(F.size("fps") > 1).select("a", F.explode("fps").alias("b")).filter("a <> b"))
    return twos.unionByName(some).unionByName(stars).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.
    Large-star and small-star rounds; each works on staged edges and never gathers a node's
    neighbours, only their minimum."""
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = stage(small, "small")
        # done when every edge points at a node that points nowhere, once per node
        chained = e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        if not chained and e.count() == e.select("u").distinct().count():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _components(base: DataFrame, id_col: str, max_bits: int, bucket_cap: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``base`` (id_col, fp)."""
    reps = stage(base.groupBy("fp").agg(F.min(id_col).alias("least_id")), "representatives")
    found = roots(links(reps.select("fp"), max_bits, bucket_cap))
    placed = reps.join(found, reps["fp"] == found["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return stage(placed.join(named, "root").select("fp", "root", "component_id"), "components")


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  max_bits: int = 2, bucket_cap: int = 64) -> DataFrame:
    """One row per input row: id_col, fingerprint (16 hex digits), component_id (the smallest id
    reachable over links of at most ``max_bits`` differing bits, the row's own included)."""
    if id_col in ("fingerprint", "component_id"):
        raise ValueError(f"{id_col} is the name of another column of the result")
    plain = df.select(F.col(f"`{id_col}`").alias("row_id"), F.col(f"`{text_col}`").alias("text"))
    base = stage(fingerprints(plain, "row_id", "text", shingle), "fingerprints")
    of_fp = _components(base, "row_id", max_bits, bucket_cap)
    return base.join(of_fp, "fp").select(
        F.col("row_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 2, bucket_cap: int = 64) -> DataFrame:
    """``df`` with one row of each group of near-duplicates, the one with the smallest id (of several
    texts with that id, that of the least fingerprint, then text hash). Of rows that repeat both
    id and text one stays; rows without an id cannot be named and all stay."""
    if "component_id" == id_col:
        raise ValueError("component_id is the name of the result's column")
    own, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    keyed = df.select(F.struct(own.alias("id"), F.xxhash64(text).alias("tie")).alias("row"), text.alias("text"))
    base = stage(fingerprints(keyed, "row", "text", shingle).select("row.id", "row.tie", "fp"), "fingerprints")
    found = base.join(_components(base, "id", max_bits, bucket_cap), "fp").filter("id = component_id")
    kept = found.groupBy("root").agg(F.min(F.struct("id", "fp", "tie")).alias("least")).select(
        F.col("least.id").alias("__kept_id"), F.col("least.tie").alias("__kept_tie"))
    named = df.filter(own.isNotNull()).withColumn("__tie", F.xxhash64(text)).join(
        kept, (own == F.col("__kept_id")) & (F.col("__tie") == F.col("__kept_tie")), "left_semi")
    named = named.dropDuplicates([id_col, "__tie"])
    return named.select(*[F.col(f"`{c}`") for c in df.columns]).unionByName(df.filter(own.isNull()))
