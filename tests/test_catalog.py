"""Every registered query against its SQL, on the same tables."""

import duckdb
import pytest
from conftest import TABLES

import __spark_entry__ as entry_point
from cueloom.catalog import oracles, queries

QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(result.columns)
    assert _rows(result.columns, result.collect()) == _rows(names, cursor.fetchall())


def test_entry_lists_them():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
