"""Every named query against its SQL, on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from millwatch.plans import oracle, queries, stream_queries
from tests.conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def test_every_query_of_the_plant_has_its_sql():
    named = {**queries.QUERIES, **stream_queries.QUERIES}
    assert set(named) == set(oracle.oracle_sql()) and set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, cur.fetchall())
