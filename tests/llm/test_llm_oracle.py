"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from polikit.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_against_sql(built, key):
    from tools.check_oracle import rows_of
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, rel = built(key), con.sql(queries.ORACLE[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_every_query_reads_its_table(built):
    for key in queries.QUERIES:
        assert len(built(key).columns) >= 3, key
