"""Every registered query against its SQL, and what the plans must not hold."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from ratemill.plans.oracles import ORACLES
from ratemill.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_python_and_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    for word in ("PythonUDF", "EvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert word not in plan
