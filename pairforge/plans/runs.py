"""End-to-end runs E1-E4: what the reference's four scripts do, as Spark plans
with durable, resumable outputs.

Each run reads its inputs, skips work already committed under ``out_path`` (resume
anti-join placed before the model hook), writes one chunk, and returns what it wrote.
Reruns without ``resume`` append again (Q5), exactly like the reference.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge import schemas as SC
from pairforge.functions import text as T
from pairforge.functions import tokens as TK
from pairforge.operators import evaluate as EV
from pairforge.operators import pairs as P
from pairforge.operators import sampling as SM
from pairforge.operators.infer import TextModel, generate_long
from pairforge.operators.joins import resume_pending
from pairforge.operators.positional import dense_index
from pairforge.operators.regroup import regroup_ordered
from pairforge.sources import io
from pairforge.sources.tables import gen_config
from pairforge.session import materialize


def _chunk(chunk_id):
    """A given id, or one that no other attempt has: UTC time and a random part."""
    return chunk_id if chunk_id is not None else time.strftime("%Y%m%dT%H%M%SZ", time.gmtime()) + f"-{uuid.uuid4().hex[:8]}"


def generation_run(
    spark: SparkSession,
    examples: DataFrame,
    model: TextModel,
    out_path: str,
    *,
    split: str = "train",
    max_examples: int | None = None,
    num_samples: int = C.NUM_SAMPLES,
    resume: bool = True,
    chunk_id=None,
    config: dict | None = None,
    dedupe: bool = False,
) -> DataFrame:
    """Examples → (split) → head-N → resume → P1 → hook (R1) → A7 → stamp → append.

    ``examples`` holds M1 rows; ``split="validation"`` keeps the exact 5 % test part.
    """
    rows = examples.select("example_id", "instruction", "input")
    if split == "validation":
        rows = SM.split_exact(rows, "example_id").filter("split = 'test'").drop("split")
    elif split != "train":
        raise ValueError("split must be 'train' or 'validation'")
    rows = SM.head(rows, "example_id", max_examples) if max_examples is not None else rows
    if dedupe:
        rows = rows.dropDuplicates(["example_id"])  # Q5: optional; the reference appends duplicates
    if resume:
        rows = resume_pending(rows, io.completed_ids(spark, out_path))
    rows = rows.select("example_id", "instruction", T.or_empty("input").alias("input"),
                       T.format_prompt("instruction", "input").alias("prompt"))
    carry = ("prompt", "instruction", "input")
    long = generate_long(rows, model, "example_id", "prompt", num_samples, carry=carry)
    long = long.filter(F.col("error").isNull()).withColumn("text", T.ensure_assistant_prefix("text"))
    grouped = regroup_ordered(
        long, "example_id", "sample_index", "text", "responses", extra={c: F.any_value(c) for c in carry}
    )
    cfg = dict(config or {})
    cfg.setdefault("model_id", model.name)
    out = grouped.select(
        "example_id", "instruction", "input", "prompt", "responses",
        gen_config(num_samples=num_samples, **cfg).alias("gen_config"),
    )
    chunk = io.append_chunk(out, out_path, _chunk(chunk_id))
    return spark.read.schema(SC.GENERATED).option("mode", "FAILFAST").json(chunk)


def judging_run(
    spark: SparkSession,
    generated: DataFrame,
    judge: TextModel,
    out_path: str,
    *,
    mode: str = C.MODE_TEACHER,
    teacher: TextModel | None = None,
    offset: int = 0,
    max_examples: int | None = None,
    resume: bool = True,
    dead_letter_path: str | None = None,
    chunk_id=None,
    dedupe: bool = False,
) -> tuple[DataFrame, dict]:
    """Generated rows → offset/limit → resume → judge → pairs (+ dead letters) → append.

    Returns the written pairs and the run counters (pending, kept, skipped).
    """
    if mode not in (C.MODE_TEACHER, C.MODE_BEST_WORST):
        raise ValueError(f"unknown mode {mode!r}")  # validated before any model is touched (Q25)
    rows = generated
    if offset or max_examples is not None:
        rows = SM.head_offset(dense_index(rows, ["example_id"], "__pos"), "__pos", offset, max_examples).drop("__pos")
    if dedupe:
        rows = rows.dropDuplicates(["example_id"])  # Q5/Q14: off by default, like the reference
    if resume:
        rows = resume_pending(rows, io.completed_ids(spark, out_path))
    judged = materialize(P.judge_candidates(rows, judge, mode), "judged")
    pairs = P.teacher_pairs(judged, teacher or judge, judge.name) if mode == C.MODE_TEACHER else P.best_worst_pairs(judged, judge.name)
    chunk = io.append_chunk(pairs, out_path, _chunk(chunk_id))
    if dead_letter_path:
        io.append_chunk(P.dead_letters(judged), dead_letter_path, chunk.rpartition("chunk=")[2])
    counters = P.skip_accounting(judged, mode).first().asDict()
    return spark.read.schema(SC.PREFERENCE).option("mode", "FAILFAST").json(chunk), counters


def evaluation_run(
    spark: SparkSession,
    examples: DataFrame,
    systems: dict[str, TextModel],
    judge: TextModel,
    out_path: str,
    summary_path: str,
    *,
    used_prompts: DataFrame | None = None,
    num_examples: int | None = None,
    seed: int = C.DEFAULT_SEED,
    resume: bool = True,
    dpo_model_path: str = "",
    sft_model_id: str = C.SFT_MODEL_ID,
    chunk_id=None,
    only_this_judge: bool = False,
    top_up: bool = False,
    dead_letter_path: str | None = None,
    exact_labels: bool = False,
) -> DataFrame:
    """Held-out rows → resume → systems → blind ranking → append; then the summary is
    recomputed over *every* row in the output (Q4) and written (K3).  ``only_this_judge``
    restricts the summary to rows this judge wrote (off by default, as in the reference).
    Examples that a system did not answer, and replies that don't parse, go to ``dead_letter_path``.
    ``exact_labels`` shuffles the labels with the reference's own generator."""
    held = EV.heldout_examples(examples, used_prompts, num_examples, shuffle_seed=seed, keep_reference=True, top_up=top_up)
    if resume:
        held = resume_pending(held, io.completed_ids(spark, out_path, "eval_id"), "eval_id")
    results, failed = EV.blind_eval(held, systems, judge, seed, exact=exact_labels)
    chunk = io.append_chunk(results, out_path, _chunk(chunk_id))
    if dead_letter_path:
        io.append_chunk(failed, dead_letter_path, chunk.rpartition("chunk=")[2])
    everything = spark.read.schema(SC.EVAL_RESULT).option("mode", "FAILFAST").json(out_path)
    if only_this_judge:
        everything = everything.filter(F.col("judge_model") == judge.name)
    summary = EV.eval_summary(everything, dpo_model_path, sft_model_id, judge.name)
    io.write_summary(summary, summary_path)
    return summary


def training_set_run(
    spark: SparkSession,
    preferences: DataFrame,
    out_path: str,
    *,
    eval_split: float = C.SPLIT_FRACTION,
    seed: int = C.DEFAULT_SEED,
    max_examples: int | None = None,
    key: str = "example_id",
    group_key: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Head-N → keep prompt/chosen/rejected (P11) → exact split (L3/L5) → align.

    The split is row-wise like the reference's (Q22: equal prompts may land on both sides).
    With ``group_key`` (e.g. ``"prompt"``) it is a stable hash-bucket split on that column
    instead: every group lands on one side, and the eval size is approximate.
    Written as Parquet ``train`` and ``eval`` tables; training itself is out of scope.
    """
    rows = preferences
    if max_examples is not None:
        rows = SM.head(dense_index(rows, [key], "__pos"), "__pos", max_examples).drop("__pos")
    P.training_pairs(rows)  # P11 check: prompt/chosen/rejected must exist
    kept = rows.select(key, "prompt", "chosen", "rejected")
    if group_key is not None and eval_split > 0:
        grouped = SM.split_bucket(kept.withColumn("__g", F.sha2(F.col(group_key), 256)), "__g", eval_split, seed)
        train = grouped.filter(F.col("split") == "train").drop("split", "__g")
        ev = grouped.filter(F.col("split") == "test").drop("split", "__g")
    else:
        train, ev = SM.train_eval(kept, key, eval_split, seed)

    def align(df: DataFrame) -> DataFrame:
        return df.select(
            "prompt",
            TK.align_completion(F.col("prompt"), F.col("chosen"))["completion"].alias("chosen"),
            TK.align_completion(F.col("prompt"), F.col("rejected"))["completion"].alias("rejected"),
        )

    align(train).write.mode("overwrite").parquet(f"{out_path}/train")
    if ev is not None:
        align(ev).write.mode("overwrite").parquet(f"{out_path}/eval")
    train_out = spark.read.parquet(f"{out_path}/train")
    eval_out = spark.read.parquet(f"{out_path}/eval") if ev is not None else None
    return train_out, eval_out
