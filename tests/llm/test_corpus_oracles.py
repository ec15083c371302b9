"""Queries of the corpus operators against their SQL."""

import pytest
from compare import difference, duck
SMALL = "/root/testdata/sf0.001"

import __spark_entry__ as entry_points
from equigauge.llm import queries as corpus


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_all_are_registered():
    assert set(corpus.QUERIES) <= set(entry_points.queries())
    assert set(corpus.ORACLES) <= set(corpus.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in corpus.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(corpus.ORACLES))
def test_query_agrees_with_sql(name, spark, con):
    assert difference(corpus.QUERIES[name](spark, SMALL), con, corpus.ORACLES[name]) is None


NATIVE = ("op1_pii", "op5_mixing")


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(name, spark):
    plan = corpus.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoop"))
