"""Every registered query at the smallest scale, beside its SQL where it has one."""

import pytest

import __spark_entry__ as driver
from tools.check import connect, differences

QUERIES, CHECKS = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    ours = QUERIES[name](spark, folder).toPandas()
    assert len(ours)
    if name in CHECKS:
        assert differences(ours, duck.execute(CHECKS[name]).df()) is None


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert sorted(r["k"] for r in rows) == [10, 25, 50]


def test_no_plan_joins_without_a_key(spark, folder):
    for name in ("metrics_by_k", "cosine_rec", "negative_sampling", "profile_mean", "split_per_user"):
        plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
