"""Every registered query against its SQL in DuckDB on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as spark_entry
from compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables here")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    sql = spark_entry.oracle_sql()[name]
    assert differences(spark, connection, SF_DIR, spark_entry.queries()[name], sql) == []


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
