"""Every registered query against its SQL counterpart."""

import pytest

from __spark_entry__ import entry
from crosscheck.registry import ORACLE, QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    rows, fault = difference(spark, con, QUERIES[name], ORACLE.get(name), SF)
    assert fault is None, fault


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry_has_one_row_per_customer(spark):
    df = entry(spark)
    assert df.count() == df.select("customer_id").distinct().count() > 0
