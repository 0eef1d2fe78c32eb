"""Scans of the driver tables and the adapter views built on them.

``examples`` maps ``conversations`` onto the instruction-row model (M1): every ``user`` turn
whose next turn is an ``assistant`` turn is one example; ``input`` is the conversation's
system text or ``''``; ``example_id`` is the 0-based position in ``(conv_id, turn)`` order.

``responses`` maps examples onto the generated-row model (M2): candidate ``j`` (0..3) of
example ``e`` is the output of example ``(e + 7*j) mod N`` passed through P4.  It is built
with a single shuffle: each example emits its own output once per ``j`` toward the example
that will hold it, and one ``groupBy`` regroups the four candidates in ``j`` order.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge.functions import text as T
from pairforge.operators.positional import dense_index
from pairforge.operators.regroup import regroup_ordered
from pairforge.session import materialize, stage_key

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

CANDIDATE_STRIDE = 7

# One materialised examples table per (session, source folder): several queries in one
# session share it the way they would share a written table.
_EXAMPLES_MEMO: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A named table scan.  Column pruning and filters reach the Parquet reader."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def examples_from_conversations(conversations: DataFrame) -> DataFrame:
    """Instruction rows (without ids) from a conversations DataFrame.

    Adjacent user→assistant turns are matched by an equi-join on ``(conv_id, turn)``
    rather than ``lead`` over a per-conversation window, so a single huge conversation does
    not land in one task.  The system text is pre-aggregated per conversation (map-side
    partial aggregation) before it meets the examples.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    users = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    replies = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    system = (
        turns.filter(F.col("role") == "system")
        .groupBy("conv_id")
        .agg(F.min_by("text", "turn").alias("system_text"))
    )
    return (
        users.join(replies, ["conv_id", "turn"], "inner")
        .join(system, "conv_id", "left")
        .select(
            "conv_id",
            "turn",
            "instruction",
            F.coalesce(F.col("system_text"), F.lit("")).alias("input"),
            "output",
        )
    )


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 rows ``example_id, conv_id, turn, instruction, input, output`` (memoised per session)."""
    key = stage_key(spark, os.path.join(sf_dir, "conversations.parquet"))
    cached = _EXAMPLES_MEMO.get(key)
    if cached is not None:
        return cached
    rows = examples_from_conversations(table(spark, sf_dir, "conversations"))
    out = dense_index(rows, ["conv_id", "turn"], id_col="example_id").select(
        "example_id", "conv_id", "turn", "instruction", "input", "output"
    )
    _EXAMPLES_MEMO[key] = out
    return out


def gen_config(
    model_id: str = C.SFT_MODEL_ID,
    num_samples: int = C.NUM_SAMPLES,
    max_new_tokens: int = C.GEN_MAX_NEW_TOKENS,
    temperature: float = 0.8,
    top_p: float = 0.95,
    no_repeat_ngram_size: int = 3,
    repetition_penalty: float = 1.1,
    seed: int = C.DEFAULT_SEED,
):
    """Generation provenance struct (M2 ``gen_config``)."""
    return F.struct(
        F.lit(model_id).alias("model_id"),
        F.lit(num_samples).cast("int").alias("num_samples"),
        F.lit(max_new_tokens).cast("int").alias("max_new_tokens"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(float(top_p)).alias("top_p"),
        F.lit(no_repeat_ngram_size).cast("int").alias("no_repeat_ngram_size"),
        F.lit(float(repetition_penalty)).alias("repetition_penalty"),
        F.lit(seed).cast("bigint").alias("seed"),
    )


def responses_from_examples(
    ex: DataFrame, num_samples: int = C.NUM_SAMPLES, stride: int = CANDIDATE_STRIDE, keep_reference: bool = False
) -> DataFrame:
    """M2 rows ``example_id, instruction, input, prompt, responses, gen_config``.

    ``keep_reference`` also carries the example's own ``output`` as ``reference_output``
    (what the deterministic teacher stub answers with), without an extra join.
    """
    n = ex.select(F.count(F.lit(1))).scalar()
    fan = ex.select(
        "example_id", "instruction", "input", "output",
        F.explode(F.sequence(F.lit(0), F.lit(num_samples - 1))).alias("j"),
    ).select(
        F.pmod(F.col("example_id") - F.lit(stride) * F.col("j"), n).alias("target"),
        "j",
        T.ensure_assistant_prefix("output").alias("text"),
        F.when(F.col("j") == 0, F.col("instruction")).alias("instruction"),
        F.when(F.col("j") == 0, F.col("input")).alias("input"),
        F.when(F.col("j") == 0, F.col("output")).alias("reference_output"),
    )
    grouped = regroup_ordered(
        fan,
        key="target",
        order="j",
        value="text",
        out="responses",
        extra={
            "instruction": F.max("instruction"),
            "input": F.max("input"),
            "reference_output": F.max("reference_output"),
        },
    )
    extra_cols = ["reference_output"] if keep_reference else []
    return grouped.select(
        F.col("target").alias("example_id"),
        "instruction",
        "input",
        T.format_prompt("instruction", "input").alias("prompt"),
        "responses",
        gen_config(num_samples=num_samples).alias("gen_config"),
        *extra_cols,
    )


_RESPONSES_MEMO: dict[tuple, DataFrame] = {}


def responses(spark: SparkSession, sf_dir: str, keep_reference: bool = False) -> DataFrame:
    """M2 rows for the driver tables; a checkpointed stage table shared within a session,
    as the generation stage's written output is shared by every later stage."""
    key = stage_key(spark, os.path.join(sf_dir, "conversations.parquet"))
    if key not in _RESPONSES_MEMO:
        _RESPONSES_MEMO[key] = materialize(responses_from_examples(examples(spark, sf_dir), keep_reference=True), "responses")
    out = _RESPONSES_MEMO[key]
    return out if keep_reference else out.drop("reference_output")


PRIOR_SEED = 7
PRIOR_FRACTION = 0.34


def prior_generation_prompts(ex: DataFrame, seed: int = PRIOR_SEED, fraction: float = PRIOR_FRACTION) -> DataFrame:
    """Prompts a previous generation run covered: a stable, seeded hash bucket of examples.

    Stands in for the ``generated_path`` side input (S6) of the evaluation stage.
    """
    from pairforge.operators.sampling import hash_bucket

    cut = int(round(fraction * 10000))
    return ex.filter(hash_bucket("example_id", seed, salt="prior:") < cut).select(
        T.format_prompt("instruction", "input").alias("prompt")
    )
