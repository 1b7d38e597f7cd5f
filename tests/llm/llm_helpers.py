"""Rows with every awkward case, for the tests of the training-data operators."""

from __future__ import annotations

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHES = ["id", "fp", "key", "tie", "part", "row", "size", "u", "h", "host", "prior", "start", "component_id", "language"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def text(rng: random.Random, n: int) -> str:
    return " ".join(words(rng, n))


def awkward(seed: int = 1) -> list[tuple]:
    """Documents: nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    rng = random.Random(seed)
    long = text(rng, 30_000)
    same = text(rng, 40)
    rows = [(i, text(rng, rng.randint(1, 60)), rng.choice(["en", "de"]), rng.choice(["a", "b", None]), 1) for i in range(30)]
    rows += [(100, None, None, None, None), (101, "", "en", "a", 0), (102, " \t\n ", "de", "b", 3), (103, long, "en", "a", 1),
             (104, same, "en", "a", 1), (105, same, "en", "b", 1), (106, same, None, None, 1), (104, same, "en", "a", 1),
             (104, same, "en", "a", 1), (107, "one", "en", "c", 3), (108, "one two", "en", "c", 7), (None, same, "en", "a", 1),
             (None, None, None, None, None), (109, "ÀÉ ßü   中文 \U0001F600", "de", "é", 4), (110, long + " x", "en", "a", 1)]
    return rows


def docs(spark, rows=None, clashes: bool = False):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(awkward() if rows is None else rows, DOC)
    if clashes:
        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    return df


def empty(spark):
    return spark.createDataFrame([], DOC)
