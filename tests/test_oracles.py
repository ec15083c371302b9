"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import difference, duck
from conftest import SMALL

from equigauge import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"train_score_audit"}


#: Plan nodes no query may need: all-pairs joins and Python per row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert difference(df, con, ORACLES[name]) is None


def test_training_is_audited(spark):
    rows = QUERIES["train_score_audit"](spark, SMALL).collect()
    assert {r["control_id"] for r in rows} == {"credit-imbalance", "fairness", "accuracy"}
    assert all(r["evaluated"] for r in rows)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 7
