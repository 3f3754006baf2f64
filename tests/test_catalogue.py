"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_point
from checks import catalogue, oracle
from compare import connect, duck_rows, spark_rows
from conftest import SF_DIR

QUERIES = catalogue.queries()
SQL = oracle.oracle_sql()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert all(entry_point.oracle_sql()[name] == SQL[name] for name in SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    described = {r[0]: r[1] for r in duck.execute("DESCRIBE " + SQL[name]).fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    assert spark_rows(df) == duck_rows(duck, SQL[name])


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["LATITUDE", "LONGITUDE", "CHLA_ADJUSTED"] and df.count() == 9
