"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__
from checks.compare import compare
from checks.registry import QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, folder, name):
    query, sql = QUERIES[name]
    equal, note = compare(spark, duck, folder, query, sql)
    assert equal, note


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns[-1] == "exp_mov_avg"
