"""Every registered key with an oracle equals DuckDB on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from opinio.fixtures import BASE_TABLES
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_key_is_documented():
    from opinio.plans.queries import REGISTRY

    assert all(q.ids for q in REGISTRY.values())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert _canon(cols, rows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sentiment", "count", "percentage"]
    assert [tuple(r) for r in df.collect()] == [r[:3] for r in df.collect()] and df.count() == 3
