"""Every registered query against its independent DuckDB SQL (sf0.001; set
POLIKIT_ORACLE_SF to use another scale)."""

import os

import pytest

from conftest import SMOKE


def _keys():
    from polikit.plans import catalog
    return sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    sf = os.environ.get("POLIKIT_ORACLE_SF", SMOKE)
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return sf, con


@pytest.mark.parametrize("key", _keys())
def test_against_oracle(built, duck, key):
    import __spark_entry__ as E
    from tools.check_oracle import rows_of
    sf, con = duck
    df = built(key, sf)
    srows = [tuple(r) for r in df.collect()]
    orc = E.oracle_sql()
    if key not in orc:
        assert isinstance(srows, list)
        return
    rel = con.sql(orc[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, srows) == rows_of(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["policy_count"] > 0
