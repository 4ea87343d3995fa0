"""Every query against its SQL on another engine, over the whole smallest test tables."""

import pytest

import __spark_entry__ as entry_module
from shopscope.catalog import CATALOG
from tests.compare import connect, difference

DIRECTORY = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry_module.queries().items() if name in CATALOG}
SQL = {name: sql for name, sql in entry_module.oracle_sql().items() if name in CATALOG}


@pytest.fixture(scope="module")
def duck():
    return connect(DIRECTORY)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, duck):
    assert difference(QUERIES[name](spark, DIRECTORY), duck, SQL[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() == 6
