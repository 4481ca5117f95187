"""Every query with SQL against DuckDB on the smallest tables."""

import pytest

from strandmill.plans.queries import ORACLE_SQL, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, con, name):
    compare(QUERIES[name](spark, SF), con, ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
