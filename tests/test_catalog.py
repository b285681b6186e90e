"""Every registered query against its SQL, over the whole tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from catalog import ORACLES, QUERIES

FOLDER = os.environ.get("RIVERSTAT_TABLES", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_returnflag", "date", "StatisticalBasis", "Result"]
    assert df.filter("StatisticalBasis = '7DMADMax'").count() == 767
