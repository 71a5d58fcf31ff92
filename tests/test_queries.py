"""Registered queries against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    yield con
    con.close()


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 60


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    expected = sorted(repr(tuple(r[names.index(c)] for c in order)) for r in cursor.fetchall())
    found = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    assert found == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 4800
