"""Text queries that SQL can express, against DuckDB on the same tables."""

import pytest

from sievemark.llm.queries import ORACLE_SQL, QUERIES
from compare import connect, differences, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(text_spark, name):
    found = spark_rows(QUERIES[name](text_spark, SF_DIR))
    assert differences(found, duck_rows(connect(SF_DIR), ORACLE_SQL[name])) == []
