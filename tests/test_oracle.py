"""Every registered query against its SQL, on the smallest scale factor."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_no_orphan_sql():
    assert set(SQL) <= set(contract.queries())
