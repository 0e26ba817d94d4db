"""Every registered query vs its DuckDB oracle (sf0.001), order-insensitive."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from presslake.plans.compare import compare
from presslake.sources.tables import TABLES

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert isinstance(rows, list)
        return
    rel = con.execute(ORACLE[name])
    r = compare(df.columns, rows, [d[0] for d in rel.description], rel.fetchall())
    assert r["schema_match"] and r["rows_match"] and r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "title" in df.columns


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)
