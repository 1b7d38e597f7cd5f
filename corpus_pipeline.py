"""The corpus pipeline: documents to token files, as five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame, which ``run`` writes as Parquet in the shared folder and reads again as the next
stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from polikit.llm import decontaminate, language_id, mixing, queries, simhash, token_codes
from polikit.llm.common import stage, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return language_id.keep_identified(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash (3-word shingles, 2 bits) stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target words."""
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; their digest by document."""
    return token_codes.read_digests(token_codes.write_codes(docs, queries.tokenizer_path()))


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_codes", token_stage),
]

#: The stages hash, iterate and use tokenizers beyond what SQL expresses; see tests/llm/test_llm_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
