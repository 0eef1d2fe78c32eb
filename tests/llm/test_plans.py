"""Which Python runs in each operator's plan: none in the native ones, the expected nodes in the others."""

import pytest

from pairforge.llm import queries
from tests.conftest import SF_SMALL

PYTHON_NODES = ("MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInPandas", "FlatMapCoGroupsInArrow", "PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op5_mixing", "op8_lines"])
def test_native_operators_have_no_python(spark, name):
    plan = _plan(queries.QUERIES[name](spark, SF_SMALL))
    assert not any(node in plan for node in PYTHON_NODES)


@pytest.mark.parametrize("name,node", [("op1_quality", "MapInArrow"), ("op3_bpe", "MapInArrow"), ("op4_fingerprint", "MapInArrow"), ("op6_toxicity", "MapInArrow"), ("op7_topk", "FlatMapCoGroupsInArrow"), ("op9_html", "MapInArrow"), ("op13_trie", "MapInArrow")])
def test_other_operators_run_in_arrow_batches(spark, name, node):
    plan = _plan(queries.QUERIES[name](spark, SF_SMALL))
    assert node in plan and not any(n in plan for n in ("BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_topk_ranks_behind_a_limit_per_group(spark):
    """The window over a query's candidates sees at most k rows a shard: the limit stands below the exchange."""
    plan = _plan(queries.QUERIES["op7_topk"](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") >= 2


def test_every_operator_has_a_query():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {"op5_mixing", "op7_topk", "op8_lines", "op11_collocations", "op13_trie"} == set(queries.ORACLE_SQL)
