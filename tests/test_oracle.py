"""Every registered query against its DuckDB SQL on the smallest benchmark set.

The session runs in a zone with an offset on purpose: no result may depend on it.
"""

import os

import pytest

import __spark_entry__ as entry
from workload.compare import difference, duck
from workload.oracle import ORACLE
from workload.spark_queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    with duck(SF_DIR) as connection:
        yield connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry.queries().keys()


def test_the_flagship_runs(spark):
    assert entry.entry(spark).columns[:2] == ["day", "hours"]


@pytest.mark.parametrize("name", QUERIES)
def test_spark_equals_sql(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(got, con.execute(ORACLE[name]).df()) is None
