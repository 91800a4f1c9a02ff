"""Every registered query against its SQL in DuckDB; queries without SQL must run."""

import pytest
from check_queries import compare, duck

from zonecast.plans.catalog import oracle_sql, queries

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf_dir, con, name):
    message, _, _ = compare(spark, con, name, queries()[name], ORACLE.get(name), sf_dir)
    assert not message


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
