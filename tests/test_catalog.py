"""Every catalog query against its SQL on the smallest given tables."""

import os

import pytest
from compare import connect, difference

from openroles.catalog.registry import spark_queries, sql_texts

FOLDER = "/root/testdata/sf0.001"
QUERIES, TEXTS = spark_queries(), sql_texts()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, TEXTS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TEXTS)))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
