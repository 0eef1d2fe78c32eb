"""Preference-pair construction (R4-R6), dead letters (F2/F3) and run counters (A4/K5).

Plan per mode (one Spark plan, no per-row Python):

    responses → rank prompt (P7/P8) → judge hook → strict verdict (J1p/J2p)
              ├─ verdict NULL or hook error → dead letter (retried on resume, Q9)
              └─ verdict ok → [teacher hook → P2∘P3∘W1]  → candidate lookups (D4) → stamp (P12)

The verdict filter sits *before* the teacher hook, so rejected rows never cost a teacher
call.  When a hook is non-deterministic (a real model), the judged frame is checkpointed
once so the kept branch and the dead-letter branch read the same verdicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge.functions import text as T
from pairforge.functions import verdict as V
from pairforge.functions.exprcache import cached_expr
from pairforge.operators.infer import TextModel
from pairforge.operators.stages import close_stage
from pairforge.session import materialize

PAIR_COLUMNS = [
    "example_id", "instruction", "input", "prompt", "judge_model", "judge_prompt_version", "preference_mode",
    "chosen", "rejected", "judge_reason", "rejected_sft_index", "best_index", "worst_index",
    "chosen_source", "rejected_source",
]


@cached_expr
def _rank_prompt_expr(mode: str):
    build = T.rank_prompt if mode == C.MODE_TEACHER else T.rank_best_worst_prompt
    return build("instruction", "input", "responses")


def judge_candidates(responses: DataFrame, judge: TextModel, mode: str = C.MODE_TEACHER) -> DataFrame:
    """Rank prompt → judge hook → parsed verdict struct (NULL when unusable)."""
    if mode not in (C.MODE_TEACHER, C.MODE_BEST_WORST):
        raise ValueError(f"unknown mode {mode!r}")
    prompted = responses.withColumn("rank_prompt", _rank_prompt_expr(mode))
    judged = judge.apply(prompted, "rank_prompt", "rank_raw")
    parse = V.with_best if mode == C.MODE_TEACHER else V.with_best_worst
    judged = parse(judged, "rank_raw", F.size("responses"), "verdict")
    if not judge.deterministic:
        # Two branches (pairs, dead letters) must see the same verdicts: write them once.
        judged = materialize(judged, "judged")
    ok = F.col("verdict").isNotNull() & F.col("rank_raw_error").isNull()
    return close_stage(
        judged,
        f"judge_{mode}",
        {"pending": F.count(F.lit(1)), "kept": F.count_if(ok), "skipped": F.count_if(~ok)},
    )


def _stamp(df: DataFrame, judge_model: str, mode: str) -> DataFrame:
    return df.withColumns(
        {
            "input": T.or_empty("input"),
            "judge_model": F.lit(judge_model),
            "judge_prompt_version": F.lit(C.JUDGE_PROMPT_VERSION),
            "preference_mode": F.lit(mode),
        }
    )


def teacher_pairs(judged: DataFrame, teacher: TextModel, judge_model: str) -> DataFrame:
    """chosen = fresh teacher answer, rejected = the judge's best SFT candidate."""
    kept = judged.filter(F.col("verdict").isNotNull() & F.col("rank_raw_error").isNull())
    chat = kept.withColumn("chat_prompt", T.flatten_chat(T.chat_messages("instruction", "input")))
    answered = teacher.apply(chat, "chat_prompt", "teacher_raw")
    answered = close_stage(answered, "teacher", {"answered": F.count_if(F.col("teacher_raw_error").isNull())})
    answered = answered.filter(F.col("teacher_raw_error").isNull())
    out = answered.select(
        "example_id", "instruction", "input", "prompt",
        T.teacher_chosen("teacher_raw").alias("chosen"),
        F.get("responses", F.col("verdict.best") - 1).alias("rejected"),
        F.col("verdict.reason").alias("judge_reason"),
        F.col("verdict.best").alias("rejected_sft_index"),
        F.lit(None).cast("int").alias("best_index"),
        F.lit(None).cast("int").alias("worst_index"),
        F.lit(C.SOURCE_TEACHER).alias("chosen_source"),
        F.lit(C.SOURCE_BEST).alias("rejected_source"),
    )
    return _stamp(out, judge_model, C.MODE_TEACHER).select(*PAIR_COLUMNS)


def best_worst_pairs(judged: DataFrame, judge_model: str) -> DataFrame:
    """chosen/rejected are the judge's best and worst candidates."""
    kept = judged.filter(F.col("verdict").isNotNull() & F.col("rank_raw_error").isNull())
    out = kept.select(
        "example_id", "instruction", "input", "prompt",
        F.get("responses", F.col("verdict.best") - 1).alias("chosen"),
        F.get("responses", F.col("verdict.worst") - 1).alias("rejected"),
        F.col("verdict.reason").alias("judge_reason"),
        F.lit(None).cast("int").alias("rejected_sft_index"),
        F.col("verdict.best").alias("best_index"),
        F.col("verdict.worst").alias("worst_index"),
        F.lit(C.SOURCE_BEST).alias("chosen_source"),
        F.lit(C.SOURCE_WORST).alias("rejected_source"),
    )
    return _stamp(out, judge_model, C.MODE_BEST_WORST).select(*PAIR_COLUMNS)


def build_pairs(
    responses: DataFrame, judge: TextModel, mode: str = C.MODE_TEACHER, teacher: TextModel | None = None
) -> DataFrame:
    """Mode dispatch is a choice of plan made once, not a per-row branch."""
    judged = judge_candidates(responses, judge, mode)
    if mode == C.MODE_TEACHER:
        return teacher_pairs(judged, teacher or judge, judge.name)
    return best_worst_pairs(judged, judge.name)


def dead_letters(judged: DataFrame) -> DataFrame:
    """rows whose verdict failed to parse or whose hook call errored."""
    return judged.filter(F.col("verdict").isNull() | F.col("rank_raw_error").isNotNull()).select(
        "example_id",
        F.when(F.col("rank_raw_error").isNotNull(), F.lit("hook_error")).otherwise(F.lit("unparsed_verdict")).alias("reason"),
        F.coalesce(F.col("rank_raw_error"), F.col("rank_raw")).alias("detail"),
    )


def skip_accounting(judged: DataFrame, mode: str) -> DataFrame:
    """A4/K5: pending, kept and skipped totals for one judging run (one row)."""
    ok = F.col("verdict").isNotNull() & F.col("rank_raw_error").isNull()
    return judged.agg(
        F.lit(mode).alias("preference_mode"),
        F.count(F.lit(1)).alias("pending"),
        F.count_if(ok).alias("kept"),
        F.count_if(~ok).alias("skipped"),
        F.count_if(F.col("rank_raw_error").isNotNull()).alias("hook_errors"),
    )


def pair_union(*frames: DataFrame) -> DataFrame:
    """Append-union of outputs with ragged columns (UNION ALL, no dedupe)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def training_pairs(preferences: DataFrame) -> DataFrame:
    """Keep ``prompt, chosen, rejected``; fail early when one is missing."""
    missing = [c for c in ("prompt", "chosen", "rejected") if c not in preferences.columns]
    if missing:
        raise ValueError(f"preference rows lack columns {missing}")
    return preferences.select("prompt", "chosen", "rejected")


def pair_checks(pairs: DataFrame) -> DataFrame:
    """Q16: the reference never checks pairs; report, per mode, how many have identical sides
    or an empty side (after W1 strip and dropping the ``Assistant:`` prefix)."""
    body = lambda c: T.strip_ws(T.strip_assistant_prefix(T.strip_ws(c)))
    return pairs.groupBy("preference_mode").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.col("chosen") == F.col("rejected")).alias("same_text"),
        F.count_if(body(F.col("chosen")) == "").alias("empty_chosen"),
        F.count_if(body(F.col("rejected")) == "").alias("empty_rejected"),
    )
