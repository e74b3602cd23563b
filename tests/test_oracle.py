"""Every query that SQL can state gives the rows DuckDB gives, on the whole tables."""

import oracle
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def duck():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    types, rows = oracle.spark_rows(entry.queries()[name](spark, oracle.DATA))
    sql_types, sql_rows = oracle.duck_rows(duck, entry.oracle_sql()[name])
    assert types == sql_types
    assert rows == sql_rows


def test_sql_only_for_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
