"""Every query with SQL gives the rows of the SQL."""

import pytest
from oracle import difference

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(spark, name, entry.queries()[name], entry.oracle_sql()[name], DATA) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
