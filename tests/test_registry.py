"""Every registered query against its SQL on the smallest tables."""

import pytest

from compare import connect, differences
from perigee.bindings.registry import load

SF = "/root/testdata/sf0.001"
QUERIES = load()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    q = QUERIES[name]
    assert q.sql is not None and q.covers
    assert differences(q.run(spark, SF), q.sql, con) == []


def test_entry_runs(spark):
    import __spark_entry__ as driver

    df = driver.entry(spark)
    assert df.count() > 0 and set(driver.oracle_sql()) <= set(driver.queries())
