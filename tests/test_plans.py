"""Plan checks: no Python in native queries, no single-task windows,
column pruning and pushed filters at the scans, anti-joins where resume/leakage apply."""

import pytest

import __spark_entry__ as E
from pairforge.operators import pairs as P
from pairforge.functions import stub_models as S
from pairforge import constants as C
from pairforge.sources import tables as TB
from tests.conftest import SF_SMALL

PYTHON_NODES = (
    "MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow",
    "FlatMapCoGroupsInPandas", "FlatMapCoGroupsInArrow", "PythonUDF", "TransformWithState",
)
# Queries whose feature is a hook (a model, a learned tokeniser, the standard library's generator), and one
# that looks for many patterns at once.
HOOK_QUERIES = {"generate_candidates": "MapInPandas", "boundary_learned": "ArrowEvalPython", "blind_labels_exact": "ArrowEvalPython", "isolated_failures": "MapInPandas", "benchmark_overlap_short": "MapInArrow"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.REGISTRY) - set(HOOK_QUERIES)))
def test_native_queries_have_no_python_and_no_window(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert not any(node in plan for node in PYTHON_NODES), name
    assert "Window" not in plan, name


@pytest.mark.parametrize("name,node", sorted(HOOK_QUERIES.items()))
def test_hook_query_runs_python_once_per_batch(spark, name, node):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert sum(plan.count(f"{n} ") for n in PYTHON_NODES if n != "PythonUDF") == plan.count(f"{node} ") == 1


def test_event_scan_is_pruned(spark):
    plan = _plan(E.queries()["latest_valid"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,props:string>" in plan


def test_conversation_filters_pushed(spark):
    rows = TB.examples_from_conversations(TB.table(spark, SF_SMALL, "conversations"))
    plan = _plan(rows)
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)" in plan
    assert "EqualTo(role,assistant)" in plan and "EqualTo(role,system)" in plan


def test_resume_and_leakage_use_anti_joins(spark):
    from pairforge.operators.evaluate import heldout_examples

    assert "LeftAnti" in _plan(E.queries()["resume_pending"](spark, SF_SMALL))
    ex = TB.examples(spark, SF_SMALL)
    held = heldout_examples(ex, TB.prior_generation_prompts(ex))
    assert "LeftAnti" in _plan(held)


def test_pairs_unchanged_under_repartition(spark):
    resp = TB.responses(spark, SF_SMALL, keep_reference=True)
    base = None
    for k in (1, 7, 64):
        df = P.build_pairs(resp.repartition(k), S.stub_judge(C.MODE_TEACHER), C.MODE_TEACHER,
                           S.stub_teacher(reference="reference_output"))
        got = sorted(tuple(r) for r in df.select("example_id", "chosen", "rejected").collect())
        base = base or got
        assert got == base


def test_resume_partition_of_input(spark):
    """pending ∪ done = input, disjoint."""
    resp = TB.responses(spark, SF_SMALL)
    done = E.queries()["pairs_teacher"](spark, SF_SMALL).select("example_id")
    pending = E.queries()["resume_pending"](spark, SF_SMALL).select("example_id")
    ids = {r.example_id for r in resp.select("example_id").collect()}
    d = {r.example_id for r in done.collect()}
    p = {r.example_id for r in pending.collect()}
    assert d | p == ids and not (d & p)
