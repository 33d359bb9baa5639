"""Every catalogue query against its DuckDB oracle, on sf0.001."""

import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL
from glebe.plans.catalog import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() >= 0 and df.columns[:2] == ["file", "pos"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(key)
    if sql is None:
        assert len(rows) > 0
        return
    cur = duck.execute(sql)
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(rows, df.columns) == _bag(orows, ocols)
