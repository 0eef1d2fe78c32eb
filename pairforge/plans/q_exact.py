"""Registered queries: the reference's own label shuffle (L6), alignment with a learned tokeniser (T4) and
resuming from a written output (S4, D1, K1)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge import constants as C
from pairforge import oracle as O
from pairforge.functions import mersenne as MT
from pairforge.functions import subword as SW
from pairforge.operators import evaluate as EV
from pairforge.plans.catalog import _judged_best_sql, _teacher_pairs_df, register
from pairforge.session import materialize
from pairforge.sources import tables as TB
from pairforge.sources.done import ResumableOutput
from pairforge.streaming.streams import run_folder

# The generator in SQL: 32-bit steps over lists.  Words 1..623 follow from one pass, the second pass starts at
# word 2 (both wrap once); then the first 40 output words, of which a shuffle of three takes the accepted ones.
_STEP = "(xor(({x}), ({x}) >> 30) * {f} & 4294967295)"


def _step(x: str, factor: int) -> str:
    return _STEP.format(x=x, f=factor)


_MT_SQL = f"""
_base AS (SELECT {MT.first_state()} AS b),
_seed AS (SELECT example_id AS eval_id, {C.DEFAULT_SEED} + example_id AS k FROM examples),
_one AS (SELECT eval_id, k, b, list_reduce(list_concat([[b[1]]], list_transform(range(2, 625), lambda i: [i])),
   lambda acc, x: list_append(acc, (xor(b[x[1]], {_step('acc[-1]', MT.ARRAY_FACTOR)}) + k) & 4294967295)) AS m FROM _seed, _base),
_two AS (SELECT eval_id, list_reduce(list_concat([[(xor(m[2], {_step('m[624]', MT.ARRAY_FACTOR)}) + k) & 4294967295]], list_transform(range(2, 624), lambda i: [i])),
   lambda acc, x: list_append(acc, (xor(m[x[1] + 1], {_step('acc[-1]', MT.LAST_FACTOR)}) - x[1]) & 4294967295)) AS w FROM _one),
_state AS (SELECT eval_id, list_concat([{MT.UPPER}, (xor(w[1], {_step('w[623]', MT.LAST_FACTOR)}) - 1) & 4294967295], w[2:]) AS s FROM _two),
_raw AS (SELECT eval_id, list_transform(range(1, 41), lambda t: xor(xor(s[t + {MT.MIDDLE}], ((s[t] & {MT.UPPER}) | (s[t + 1] & {MT.LOWER})) >> 1), (s[t + 1] & 1) * {MT.TWIST})) AS y FROM _state),
_t1 AS (SELECT eval_id, list_transform(y, lambda v: xor(v, v >> 11)) AS y FROM _raw),
_t2 AS (SELECT eval_id, list_transform(y, lambda v: xor(v, (v << 7) & {MT.MASK_B})) AS y FROM _t1),
_t3 AS (SELECT eval_id, list_transform(y, lambda v: xor(v, (v << 15) & {MT.MASK_C})) AS y FROM _t2),
_bits AS (SELECT eval_id, list_transform(y, lambda v: xor(v, v >> 18) >> 30) AS d FROM _t3),
_at AS (SELECT *, list_filter(range(1, 41), lambda t: d[t] < 3)[1] AS a FROM _bits),
_draw AS (SELECT eval_id, d[a] AS j2, d[list_filter(range(1, 41), lambda t: t > a AND d[t] < 2)[1]] AS j1 FROM _at),
_swap AS (SELECT eval_id, j1, CASE j2 WHEN 0 THEN [2, 1, 0] WHEN 1 THEN [0, 2, 1] ELSE [0, 1, 2] END AS o FROM _draw),
_order AS (SELECT eval_id, CASE j1 WHEN 0 THEN [o[2], o[1], o[3]] ELSE o END AS o FROM _swap)"""


@register(
    "blind_labels_exact",
    O.with_ctes(
        O.EXAMPLES_CTE + "," + _MT_SQL,
        f"SELECT eval_id, {', '.join(f'({list(C.SYSTEMS)})[o[{i}] + 1] AS label_{i}' for i in (1, 2, 3))} FROM _order",
    ),
    "L6 bit for bit: the standard library's seeded shuffle of the systems, for every example",
)
def blind_labels_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = EV.blind_labels_exact(F.col("example_id"))
    rows = TB.examples(spark, sf_dir).select(F.col("example_id").alias("eval_id"), order.alias("o"))
    return rows.select("eval_id", *[F.get("o", F.lit(i - 1)).alias(f"label_{i}") for i in (1, 2, 3)])


def tokenizer_file() -> str:
    """The byte-level vocabulary that stands in for the base model's tokeniser."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("boundary_learned", None, "T4 (a)-(d) for both sides of every pair with a learned byte-level tokeniser that merges across the boundary; the cut by offset search")
def boundary_learned(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """One row a side: branch, token counts, the cut and the completion's digest.  ``path`` is the tokeniser file."""
    pairs = materialize(_teacher_pairs_df(spark, sf_dir).select("example_id", "prompt", "chosen", "rejected"), "pairs")
    sides = pairs.select(
        "example_id", "prompt",
        F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("text")) for s in ("chosen", "rejected")])).alias("s"),
    ).select("example_id", "s.side", SW.align_learned(path or tokenizer_file(), F.col("prompt"), F.col("s.text")).alias("a"))
    return sides.select("example_id", "side", "a.prefix_dropped", "a.branch", "a.n_prompt_tokens", "a.n_joint_tokens", "a.cut", F.md5("a.completion").alias("completion_md5"))


_OUTPUT = T.StructType([T.StructField("example_id", T.LongType()), T.StructField("chosen", T.StringType()), T.StructField("rejected", T.StringType())])


@register(
    "resume_written",
    O.with_ctes(
        O.RESPONSES_CTE + _judged_best_sql(),
        """SELECT v.example_id, CASE WHEN NOT ok THEN NULL WHEN v.example_id < (SELECT count(*) // 2 FROM examples) THEN 'a' ELSE 'b' END AS written_in,
             NOT ok AS pending FROM verdicts v""",
    ),
    "S4/D1/K1 two judging runs over one written output: the second resumes from the bucketed ids the first left; per example the chunk it was written in",
)
def resume_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ``a`` is interrupted half way (the reference's offset and limit); run ``b`` takes all candidates and
    skips what is done.  The result is read from the written output."""
    width = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = ResumableOutput(spark, os.path.join(run_folder(spark, "resumable"), "pairs"), _OUTPUT, buckets=width)
    pairs, ids = _teacher_pairs_df(spark, sf_dir), TB.responses(spark, sf_dir).select("example_id")
    half = ids.count() // 2
    out.commit(out.pending(pairs.filter(F.col("example_id") < half)), "a")
    out.commit(out.pending(pairs), "b")
    left = out.pending(ids).select("example_id", F.lit(None).cast("string").alias("written_in"), F.lit(True).alias("pending"))
    return out.rows().select("example_id", F.col("chunk").alias("written_in"), F.lit(False).alias("pending")).unionByName(left)
