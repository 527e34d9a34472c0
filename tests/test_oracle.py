"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from boxlake.catalog import QUERIES
from tests.check_oracle import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, name):
    sql = oracle_sql().get(name)
    assert sql, "every query has an oracle"
    _, rows, message = compare(spark, FOLDER, name, queries()[name], sql)
    assert message == ""


def test_flagship(spark):
    assert entry(spark).count() > 0
