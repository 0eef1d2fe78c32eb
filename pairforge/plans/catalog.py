"""Registered queries: each a Spark plan over the driver tables plus its DuckDB oracle.

A query is a function ``(spark, sf_dir) -> DataFrame``.  Its oracle is DuckDB SQL over the
same tables (views named like the Parquet files).  Computed columns carry the same aliases
on both sides.
"""

from __future__ import annotations

import os

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pairforge import constants as C
from pairforge import oracle as O
from pairforge.functions import stub_models as S
from pairforge.operators import pairs as P
from pairforge.session import stage_key
from pairforge.sources import tables as TB


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, doc: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, doc)
        return fn

    return deco


# ---------------------------------------------------------------------------------------------
# Minimum slice: examples → P1 → stub verdict → J1p → D4 → teacher pair
# ---------------------------------------------------------------------------------------------

_PAIR_SELECT = """example_id, instruction, input, prompt, {judge} AS judge_model, {ver} AS judge_prompt_version,
  {mode} AS preference_mode, chosen, rejected, judge_reason, CAST(rejected_sft_index AS INTEGER) AS rejected_sft_index,
  CAST(best_index AS INTEGER) AS best_index, CAST(worst_index AS INTEGER) AS worst_index,
  {cs} AS chosen_source, {rs} AS rejected_source"""


def _judged_best_sql(p: str = "") -> str:
    sp = "span"
    return f""",
{p}_j AS (SELECT r.*, {O.best_reply('r.example_id', 'r.responses')} AS rank_raw FROM responses r),
{p}_s AS (SELECT *, {O.span('rank_raw')} AS span FROM {p}_j),
{p}judged AS (
  SELECT *, CASE WHEN {O.valid_span(sp)} THEN {O.py_int(O.field(sp, 'best'))} END AS best,
            CASE WHEN {O.valid_span(sp)} THEN {O.reason(sp)} END AS reason
  FROM {p}_s
),
{p}verdicts AS (SELECT *, coalesce(best BETWEEN 1 AND len(responses), false) AS ok FROM {p}judged)"""


def _judged_best_worst_sql(p: str = "") -> str:
    sp = "span"
    return f""",
{p}_j AS (SELECT r.*, {O.best_worst_reply('r.example_id', 'r.responses')} AS rank_raw FROM responses r),
{p}_s AS (SELECT *, {O.span('rank_raw')} AS span FROM {p}_j),
{p}judged AS (
  SELECT *, CASE WHEN {O.valid_span(sp)} THEN {O.py_int(O.field(sp, 'best'))} END AS best,
            CASE WHEN {O.valid_span(sp)} THEN {O.py_int(O.field(sp, 'worst'))} END AS worst,
            CASE WHEN {O.valid_span(sp)} THEN {O.reason(sp)} END AS reason
  FROM {p}_s
),
{p}verdicts AS (
  SELECT *, coalesce(best BETWEEN 1 AND len(responses) AND worst BETWEEN 1 AND len(responses) AND best <> worst, false) AS ok
  FROM {p}judged
)"""


_TEACHER_PAIRS: dict = {}


def _teacher_pairs_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teacher pairs over the driver tables; the DataFrame (a plan, not data) is reused by
    the queries of one session, each of which still executes it in full."""
    key = stage_key(spark, os.path.join(sf_dir, "conversations.parquet"))
    if key not in _TEACHER_PAIRS:
        resp = TB.responses(spark, sf_dir, keep_reference=True)
        _TEACHER_PAIRS[key] = P.build_pairs(
            resp, S.stub_judge(C.MODE_TEACHER), C.MODE_TEACHER, S.stub_teacher(reference="reference_output")
        )
    return _TEACHER_PAIRS[key]


def _teacher_pairs_sql_body(p: str = "") -> str:
    sel = _PAIR_SELECT.format(
        judge=O.q(S.STUB_JUDGE_ID), ver=O.q(C.JUDGE_PROMPT_VERSION), mode=O.q(C.MODE_TEACHER),
        cs=O.q(C.SOURCE_TEACHER), rs=O.q(C.SOURCE_BEST),
    )
    return f"""SELECT {sel} FROM (
  SELECT example_id, instruction, input, prompt,
         {O.teacher_chosen(O.teacher_reply('example_id', 'reference_output'))} AS chosen,
         responses[best] AS rejected, reason AS judge_reason, best AS rejected_sft_index,
         NULL AS best_index, NULL AS worst_index
  FROM {p}verdicts WHERE ok)"""


@register(
    "pairs_teacher",
    O.with_ctes(O.RESPONSES_CTE + _judged_best_sql(), _teacher_pairs_sql_body()),
    "R4 teacher pairs: stub judge picks the best SFT candidate (rejected); teacher answer is chosen",
)
def pairs_teacher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _teacher_pairs_df(spark, sf_dir)
