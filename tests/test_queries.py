"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    run, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert differences(run, sql, spark, con, SF) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["types", "accesstime", "data", "count"]
