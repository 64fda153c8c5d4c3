"""Every query against its SQL twin on the smallest tables, and what no plan may hold."""

import pytest
from compare import connect, difference

from areascore.scratch import release
from areascore.testbed import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


# Python workers, all-pairs joins and driver-made rows have no place in any plan.
UNWANTED = [
    "Python",
    "Pandas",
    "ArrowEval",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "Scan ExistingRDD",
]


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    assert name in SQL
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [node for node in UNWANTED if node in plan] == []
    assert difference(spark, con, lambda *_: df, SQL[name], SF_DIR) is None
    release(spark)


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
