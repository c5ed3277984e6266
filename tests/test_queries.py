"""Every registered query agrees with its SQL; plans hold no row-wise Python and no cross joins."""

import pytest

import __spark_entry__
import workloads
from tests.conftest import SF
from workloads.verify import compare, oracle


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 25
    assert set(workloads.ORACLES) == set(workloads.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(workloads.QUERIES))
def test_query(spark, con, name):
    df = workloads.QUERIES[name](spark, SF)
    problem, n = compare(df, con, workloads.ORACLES.get(name))
    assert not problem
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
