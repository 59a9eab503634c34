"""Every registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as contract
from oracle_queries import ORACLE_SQL
from sievemark.plans import star

from compare import connect, differences, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(star.QUERIES) == set(ORACLE_SQL)
    assert set(star.QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(star.QUERIES))
def test_query_matches_oracle(spark, connection, name):
    found = spark_rows(contract.queries()[name](spark, SF_DIR))
    wanted = duck_rows(connection, contract.oracle_sql()[name])
    assert differences(found, wanted) == []


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["rain_level", "value_range"]
    assert df.count() > 0
