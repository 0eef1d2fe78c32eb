"""Deterministic stand-ins for the judge, teacher and evaluated systems.

They let every query run end to end on the driver tables without model weights, and are
written with the same literals in the DuckDB oracle.  The judge is a length heuristic: the
longest candidate is "best", the shortest "worst" (first on ties).  Its reply text cycles
through ten shapes by ``id % 10`` so that the strict parser sees clean JSON, prose around
JSON, quoted numbers, fractions, out-of-range indices, two objects, no JSON, extra keys,
single quotes and duplicate keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge.functions.exprcache import cached_expr
from pairforge.operators.infer import ExpressionModel

STUB_JUDGE_ID = "stub/length-judge"
STUB_TEACHER_ID = "stub/echo-teacher"


def longest_index(responses: Column) -> Column:
    lens = F.transform(responses, lambda x: F.length(x))
    return F.array_position(lens, F.array_max(lens)).cast("int")


def shortest_index(responses: Column) -> Column:
    lens = F.transform(responses, lambda x: F.length(x))
    return F.array_position(lens, F.array_min(lens)).cast("int")


def _s(c: Column) -> Column:
    return c.cast("string")


def best_reply(key: Column, responses: Column | None, best: Column | None = None, worst: Column | None = None) -> Column:
    """Judge reply to the single-best prompt."""
    b = _s(best if best is not None else longest_index(responses))
    w = _s(worst if worst is not None else shortest_index(responses))
    k = F.pmod(key, F.lit(10))
    lit = F.lit
    return (
        F.when(k == 0, F.concat(lit('{"best": '), b, lit(', "reason": "most complete answer"}')))
        .when(k == 1, F.concat(lit('After reading all candidates: {"best": '), b, lit(', "reason": "clearest"} Done.')))
        .when(k == 2, F.concat(lit('{"best": "'), b, lit('", "reason": "quoted index"}')))
        .when(k == 3, F.concat(lit('{"best": '), b, lit('.7, "reason": "fractional index"}')))
        .when(k == 4, lit('{"best": 9, "reason": "out of range"}'))
        .when(k == 5, F.concat(lit('{"best": '), b, lit('} and {"best": 1}')))
        .when(k == 6, lit("I cannot decide between these responses."))
        .when(k == 7, F.concat(lit('{"best": '), b, lit(', "worst": '), w, lit(', "reason": "both ends"}')))
        .when(k == 8, F.concat(lit("{'best': "), b, lit(", 'reason': 'single quotes'}")))
        .otherwise(F.concat(lit('{"best": 1, "best": '), b, lit(', "reason": "second key wins"}')))
    )


def best_worst_reply(key: Column, responses: Column | None, best: Column | None = None, worst: Column | None = None) -> Column:
    """Judge reply to the best/worst prompt."""
    b = _s(best if best is not None else longest_index(responses))
    w = _s(worst if worst is not None else shortest_index(responses))
    k = F.pmod(key, F.lit(10))
    lit = F.lit
    return (
        F.when(k == 0, F.concat(lit('{"best": '), b, lit(', "worst": '), w, lit(', "reason": "most and least complete"}')))
        .when(k == 1, F.concat(lit('Verdict: {"best": '), b, lit(', "worst": '), w, lit(', "reason": "clear"} end')))
        .when(k == 2, F.concat(lit('{"best": "'), b, lit('", "worst": "'), w, lit('", "reason": "quoted"}')))
        .when(k == 3, F.concat(lit('{"best": '), b, lit('.7, "worst": '), w, lit('.2, "reason": "fractional"}')))
        .when(k == 4, F.concat(lit('{"best": '), b, lit(', "worst": 9, "reason": "worst out of range"}')))
        .when(k == 5, F.concat(lit('{"best": '), b, lit(', "worst": '), w, lit('} and {"best": 1, "worst": 2}')))
        .when(k == 6, lit("No verdict."))
        .when(k == 7, F.concat(lit('{"best": '), b, lit(', "worst": '), b, lit(', "reason": "same index"}')))
        .when(k == 8, F.concat(lit('{"best": '), b, lit(', "reason": "worst missing"}')))
        .otherwise(F.concat(lit('{"best": '), w, lit(', "worst": '), w, lit(', "best": '), b, lit(', "reason": "duplicate key"}')))
    )


def teacher_reply(key: Column, reference_output: Column) -> Column:
    """Teacher answer: the reference output, in three wrappings that exercise W1 and P3."""
    k = F.pmod(key, F.lit(3))
    return (
        F.when(k == 0, reference_output)
        .when(k == 1, F.concat(F.lit("  " + C.ASSISTANT_PREFIX + "  "), reference_output, F.lit("\n")))
        .otherwise(F.concat(F.lit(C.ASSISTANT_PREFIX + " " + C.ASSISTANT_PREFIX + " "), reference_output))
    )


@cached_expr
def _judge_reply(mode: str, key: str):
    reply = best_reply if mode == C.MODE_TEACHER else best_worst_reply
    return reply(F.col(key), None, F.col("__stub_b"), F.col("__stub_w"))


@cached_expr
def _judge_indices(responses: str):
    return longest_index(F.col(responses)), shortest_index(F.col(responses))


def stub_judge(mode: str = C.MODE_TEACHER, key: str = "example_id", responses: str = "responses") -> ExpressionModel:
    def prepare(df):
        b, w = _judge_indices(responses)
        return df.withColumns({"__stub_b": b, "__stub_w": w})

    return ExpressionModel(
        STUB_JUDGE_ID,
        lambda _prompt: _judge_reply(mode, key),
        prepare=prepare,
        cleanup=["__stub_b", "__stub_w"],
    )


def stub_teacher(key: str = "example_id", reference: str = "output") -> ExpressionModel:
    return ExpressionModel(STUB_TEACHER_ID, lambda _prompt: teacher_reply(F.col(key), F.col(reference)))


# ---- evaluated systems and the blind ranking judge ------------------------------------------

STUB_RANK_JUDGE_ID = "stub/length-ranker"


def stub_systems(instruction: str = "instruction", reference: str = "reference_output") -> dict[str, ExpressionModel]:
    """Three systems built from whole texts: a prompt parrot (the instruction), the reference
    answer, and the answer followed by the instruction (always the longest)."""
    return {
        "pretrained": ExpressionModel("stub/pretrained", lambda _p: F.col(instruction)),
        "sft": ExpressionModel("stub/sft", lambda _p: F.col(reference)),
        "dpo": ExpressionModel("stub/dpo", lambda _p: F.concat(F.col(reference), F.lit("\n"), F.col(instruction))),
    }


def length_order(labelled: Column) -> Column:
    """Labels 1..n ordered by response length, longest first (ties: lower label first)."""
    n = F.size(labelled)
    keyed = F.transform(
        F.sequence(F.lit(1), n), lambda lab: F.struct((-F.length(F.get(labelled, lab - 1))).alias("k"), lab.alias("l"))
    )
    return F.transform(F.array_sort(keyed), lambda x: x["l"].cast("string"))


def ranking_reply(key: Column, labelled: Column | None, order: Column | None = None) -> Column:
    """Judge reply to the blind prompt (P9), cycling through eight shapes by ``key % 8``."""
    o = order if order is not None else length_order(labelled)
    a, b, c = F.get(o, 0), F.get(o, 1), F.get(o, 2)
    k = F.pmod(key, F.lit(8))
    lit = F.lit
    return (
        F.when(k == 0, F.concat(lit('{"ranking": ['), a, lit(", "), b, lit(", "), c, lit('], "reason": "longest first"}')))
        .when(k == 1, F.concat(lit('Ranking: {"ranking": ["'), a, lit('", "'), b, lit('", "'), c, lit('"], "reason": "strings"} done')))
        .when(k == 2, F.concat(lit('{"ranking": "'), a, b, c, lit('", "reason": "compact"}')))
        .when(k == 3, F.concat(lit('{"ranking": {"'), a, lit('": 0, "'), b, lit('": 0, "'), c, lit('": 0}, "reason": "object keys"}')))
        .when(k == 4, F.concat(lit('{"ranking": ['), a, lit(", "), a, lit(", "), c, lit('], "reason": "repeated"}')))
        .when(k == 5, F.concat(lit('{"ranking": ['), a, lit(", "), b, lit('], "reason": "short"}')))
        .when(k == 6, lit("The first one is best."))
        .otherwise(F.concat(lit('{"ranking": ['), a, lit(".0, "), b, lit(", "), c, lit('], "reason": "float"}')))
    )


@cached_expr
def _ranking_reply(key: str):
    return ranking_reply(F.col(key), None, F.col("__stub_order"))


@cached_expr
def _length_order(labelled: str):
    return length_order(F.col(labelled))


def stub_rank_judge(key: str = "eval_id", labelled: str = "labelled_responses") -> ExpressionModel:
    return ExpressionModel(
        STUB_RANK_JUDGE_ID,
        lambda _prompt: _ranking_reply(key),
        prepare=lambda df: df.withColumn("__stub_order", _length_order(labelled)),
        cleanup=["__stub_order"],
    )


# ---- a Python-side generation stub behind the Arrow hook ------------------------------------

STUB_GENERATOR_ID = "stub/echo-sampler"


def echo_sampler_factory():
    """Factory for ``PandasModel``: sample ``j`` repeats the whole stripped prompt ``j + 1``
    times, space-separated.

    Stands in for a sampling language model so the ``mapInPandas`` path (worker-level model
    cache, batching, error isolation, long output + regroup) runs on real rows.
    """

    def generate(prompts: list[str], num_samples: int) -> list[list[str]]:
        return [[" ".join([p.strip()] * (j + 1)) for j in range(num_samples)] for p in prompts]

    return generate
