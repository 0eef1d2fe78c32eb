"""Registered queries: blind three-way evaluation and its summary (R2, D3, D5, L6, P9, J3p, N2, N3, R7, A1-A5)."""

from __future__ import annotations

import os
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge import oracle as O
from pairforge.functions import stub_models as S
from pairforge.operators import evaluate as EV
from pairforge.plans.catalog import REGISTRY, register
from pairforge.plans.q_pairs import _heldout
from pairforge.session import stage_key
from pairforge.sources import tables as TB

DPO_MODEL_PATH = "./dpo_checkpoints"


_PLANS: dict = {}


def _plan(key, build):
    """Reuse a DataFrame (a plan, not data) across the queries of one session; each query
    still executes it in full."""
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def _rows(spark, sf_dir, everything) -> DataFrame:
    return EV.all_examples(TB.examples(spark, sf_dir)) if everything else _heldout(spark, sf_dir, keep_reference=True)


def _prepared(spark, sf_dir, everything) -> DataFrame:
    key = ("prepared", everything, stage_key(spark, os.path.join(sf_dir, "conversations.parquet")))
    return _plan(key, lambda: EV.prepare_blind(_rows(spark, sf_dir, everything), S.stub_systems()))


def _judged(spark, sf_dir, everything) -> DataFrame:
    key = ("judged", everything, stage_key(spark, os.path.join(sf_dir, "conversations.parquet")))
    return _plan(key, lambda: EV.judge_blind(_prepared(spark, sf_dir, everything), S.stub_rank_judge(), len(C.SYSTEMS)))


def _results(spark, sf_dir, everything) -> DataFrame:
    return EV.blind_results(_judged(spark, sf_dir, everything), S.STUB_RANK_JUDGE_ID)


def _join(c, sep=","):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


@register(
    "assemble_systems",
    O.with_ctes(O.EVAL_ALL_CTE, "SELECT eval_id, resp_pretrained, resp_sft, resp_dpo FROM blind"),
    "R2/D3 one generation stage per system, long rows regrouped by id into a map (never zipped by position)",
)
def assemble_systems(spark: SparkSession, sf_dir: str, everything: bool = True) -> DataFrame:
    p = _prepared(spark, sf_dir, everything)
    return p.select("eval_id", *[F.col("responses")[s].alias(f"resp_{s}") for s in C.SYSTEMS])


@register(
    "blind_labels",
    O.with_ctes(
        O.EVAL_ALL_CTE,
        "SELECT eval_id, label_order[1] AS label_1, label_order[2] AS label_2, label_order[3] AS label_3 FROM blind",
    ),
    "L6/J4p per-row seeded label permutation keyed by seed + eval_id",
)
def blind_labels(spark: SparkSession, sf_dir: str, everything: bool = True) -> DataFrame:
    p = _prepared(spark, sf_dir, everything)
    return p.select("eval_id", *[F.col("label_to_model")[str(i)].alias(f"label_{i}") for i in (1, 2, 3)])


@register(
    "blind_prompt",
    O.with_ctes(
        O.EVAL_ALL_CTE,
        f"SELECT eval_id, {O.rank_prompt(C.BLIND_RANK_SYSTEM, 'instruction', 'input', O.candidate_block('labelled'))} AS blind_prompt FROM blind",
    ),
    "P9 blind three-way prompt in label order",
)
def blind_prompt(spark: SparkSession, sf_dir: str, everything: bool = True) -> DataFrame:
    return _prepared(spark, sf_dir, everything).select("eval_id", "blind_prompt")


@register(
    "parse_ranking",
    O.with_ctes(
        O.EVAL_ALL_CTE,
        """SELECT eval_id, CASE WHEN ok THEN array_to_string(items, ',') END AS ranking,
                  CASE WHEN ok THEN reason END AS reason FROM parsed""",
    ),
    "J3p/F6 ranking verdicts: arrays, digit strings and object keys, permutation check",
)
def parse_ranking(spark: SparkSession, sf_dir: str, everything: bool = True) -> DataFrame:
    j = _judged(spark, sf_dir, everything)
    return j.select("eval_id", _join(F.col("parsed.ranking")).alias("ranking"), F.col("parsed.reason").alias("reason"))


@register(
    "rank_metrics",
    O.with_ctes(
        O.EVAL_ALL_CTE,
        """SELECT eval_id, dpo_beats_sft, sft_beats_pretrained, best_model,
                  array_to_string(ranking_models, ',') AS ranking_models FROM results""",
    ),
    "N2/N3/D5 positions per system, pairwise beat flags, best system, ordered systems",
)
def rank_metrics(spark: SparkSession, sf_dir: str, everything: bool = True) -> DataFrame:
    r = _results(spark, sf_dir, everything)
    return r.select("eval_id", "dpo_beats_sft", "sft_beats_pretrained", "best_model", _join(F.col("ranking_models")).alias("ranking_models"))


@register(
    "blind_eval",
    O.with_ctes(
        O.EVAL_ALL_CTE,
        f"""SELECT eval_id, instruction, input, prompt, array_to_string(ranking, ',') AS ranking,
                  '1=' || label_order[1] || ',2=' || label_order[2] || ',3=' || label_order[3] AS label_to_model,
                  judge_reason, {O.q(S.STUB_RANK_JUDGE_ID)} AS judge_model, true AS blind_ranking,
                  dpo_beats_sft, sft_beats_pretrained, best_model, array_to_string(ranking_models, ',') AS ranking_models
           FROM results""",
    ),
    "R7 blind ranking end to end: held-out rows, three systems, label permutation, judge, strict parse, metrics",
)
def blind_eval(spark: SparkSession, sf_dir: str, everything: bool = True) -> DataFrame:
    r = _results(spark, sf_dir, everything)
    labels = F.concat_ws(",", *[F.concat(F.lit(f"{i}="), F.col("label_to_model")[str(i)]) for i in (1, 2, 3)])
    return r.select(
        "eval_id", "instruction", "input", "prompt", _join(F.col("ranking")).alias("ranking"),
        labels.alias("label_to_model"), "judge_reason", "judge_model", "blind_ranking",
        "dpo_beats_sft", "sft_beats_pretrained", "best_model", _join(F.col("ranking_models")).alias("ranking_models"),
    )


_SUMMARY_SQL = f"""SELECT count(*) AS num_examples,
  count(*) FILTER (WHERE coalesce(dpo_beats_sft, false)) AS dpo_beats_sft,
  CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE coalesce(dpo_beats_sft, false)))::DOUBLE / count(*) ELSE 0.0 END AS dpo_beats_sft_rate,
  count(*) FILTER (WHERE coalesce(sft_beats_pretrained, false)) AS sft_beats_pretrained,
  CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE coalesce(sft_beats_pretrained, false)))::DOUBLE / count(*) ELSE 0.0 END AS sft_beats_pretrained_rate,
  count(*) FILTER (WHERE best_model = 'pretrained') AS best_pretrained,
  count(*) FILTER (WHERE best_model = 'sft') AS best_sft,
  count(*) FILTER (WHERE best_model = 'dpo') AS best_dpo,
  {O.q(DPO_MODEL_PATH)} AS dpo_model_path, {O.q(C.SFT_MODEL_ID)} AS sft_model_id, {O.q(S.STUB_RANK_JUDGE_ID)} AS judge_model_id
FROM results"""


@register(
    "eval_summary",
    O.with_ctes(O.EVAL_ALL_CTE, _SUMMARY_SQL),
    "A1/A2/A5 win counts and zero-guarded rates; one row even when no result parsed",
)
def eval_summary(spark: SparkSession, sf_dir: str, everything: bool = True) -> DataFrame:
    s = EV.eval_summary(_results(spark, sf_dir, everything), DPO_MODEL_PATH, C.SFT_MODEL_ID, S.STUB_RANK_JUDGE_ID)
    return s.select(
        "num_examples", "dpo_beats_sft", "dpo_beats_sft_rate", "sft_beats_pretrained", "sft_beats_pretrained_rate",
        *[F.col("best_model_counts")[x].alias(f"best_{x}") for x in C.SYSTEMS],
        "dpo_model_path", "sft_model_id", "judge_model_id",
    )


@register(
    "best_model_counts",
    O.with_ctes(
        O.EVAL_ALL_CTE,
        """SELECT k.best_model, coalesce(c.n, 0) AS n
           FROM (VALUES ('pretrained'), ('sft'), ('dpo')) k(best_model)
           FULL OUTER JOIN (SELECT coalesce(best_model, '') AS best_model, count(*) AS n FROM results GROUP BY 1) c
             USING (best_model)""",
    ),
    "A3 best-system counts, zero-filled for the known systems",
)
def best_model_counts(spark: SparkSession, sf_dir: str, everything: bool = True) -> DataFrame:
    return EV.best_model_counts(_results(spark, sf_dir, everything))


#: The queries above evaluate every example, with its dense id as ``eval_id``; these the held-out split, as the
#: evaluation run does.
for _name in ("assemble_systems", "blind_labels", "blind_prompt", "parse_ranking", "rank_metrics", "blind_eval", "eval_summary", "best_model_counts"):
    _q = REGISTRY[_name]
    register(f"{_name}_heldout", _q.sql.replace(O.EVAL_ALL_CTE, O.EVAL_CTE), f"{_q.doc}; over the held-out split")(partial(_q.run, everything=False))
