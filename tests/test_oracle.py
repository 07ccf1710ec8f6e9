"""Every registered query against its SQL, on the smallest tables, and what no plan may contain."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from groundshift.checks import registry

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = registry.QUERIES, registry.CHECKS


def unwanted(df):
    """Joins of everything with everything, and rows handed to Python."""
    text = df._jdf.queryExecution().executedPlan().toString()
    kinds = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]
    return [k for k in kinds if k in text]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert not unwanted(df)
    assert differences(df, con, CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert not unwanted(df)
    assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 16


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
