"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from tests.compare import connect, differences
from tillhouse.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "label", "revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(found, duck.execute(SQL[name]).df()) is None
