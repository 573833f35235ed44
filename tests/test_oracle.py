"""Every query with SQL gives the SQL's rows on the smallest tables."""

import pytest
from oracle import connect, differences

from quire.plans import books, catalogue, media, trips  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows(spark, con, name):
    assert not differences(spark, con, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name], SF_DIR)


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(catalogue.QUERIES) <= set(e.queries())
