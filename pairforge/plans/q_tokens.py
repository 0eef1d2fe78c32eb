"""Registered queries: tokens, loss masks, boundaries, budgets and batch plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge import oracle as O
from pairforge.functions import text as T
from pairforge.functions import tokens as TK
from pairforge.operators.positional import batch_ids
from pairforge.plans.catalog import _judged_best_sql, _teacher_pairs_df, _teacher_pairs_sql_body, register
from pairforge.sources import tables as TB


def _join_ints(c):
    return F.array_join(c.cast("array<string>"), ",")


_SFT_PROMPT = "('Human: ' || instruction || ' ' || input || ' Assistant: ')"
_SFT_FULL = (
    f"({_SFT_PROMPT} || CASE WHEN ends_with(output, {O.q(C.EOS_TEXT)}) THEN output ELSE output || {O.q(C.EOS_TEXT)} END)"
)


@register(
    "loss_mask",
    O.with_ctes(
        O.EXAMPLES_CTE
        + f""",
_t AS (SELECT example_id, {O.token_ids(_SFT_FULL)} AS ids, {O.token_ids(_SFT_PROMPT)} AS p FROM examples),
_k AS (SELECT example_id, p, list_resize(ids, greatest(len(ids), 1024), 50256) AS input_ids,
              list_resize(list_transform(ids, lambda x: 1), greatest(len(ids), 1024), 0) AS mask, len(ids) AS n FROM _t),
_l AS (SELECT *, {O.common_prefix_len('p', 'input_ids')} AS plen FROM _k),
_m AS (SELECT *, list_transform(input_ids, lambda x, i: CASE WHEN i - 1 < plen OR mask[i] = 0 THEN -100 ELSE x END) AS labels FROM _l)""",
        """SELECT example_id, CAST(n AS INTEGER) AS n_tokens, CAST(plen AS INTEGER) AS prompt_len,
                  CAST(len(list_filter(labels, lambda x: x <> -100)) AS INTEGER) AS n_label_tokens,
                  md5(array_to_string(input_ids, ',')) AS ids_md5, md5(array_to_string(labels, ',')) AS labels_md5
           FROM _m""",
    ),
    "T1-T3 tokenise, pad to 1024 (cut only at a given length), prompt prefix by joint tokens, labels masked by prompt and attention mask",
)
def loss_mask(spark: SparkSession, sf_dir: str, max_length: int | None = None) -> DataFrame:
    """Whole texts; with ``max_length`` they are cut there and ``n_dropped`` counts the tokens lost."""
    ex = TB.examples(spark, sf_dir)
    staged = ex.select(
        "example_id",
        TK.token_ids(T.sft_text("instruction", "input", "output")).alias("ids"),
        TK.token_ids(T.sft_prompt("instruction", "input")).alias("p"),
    )
    kept, n_dropped = TK.truncate(F.col("ids"), max_length)
    input_ids, mask = TK.pad_right(kept, C.SFT_MAX_LENGTH if max_length is None else max_length)
    staged = staged.select("example_id", "p", input_ids.alias("input_ids"), mask.alias("mask"), n_dropped.alias("n_dropped"))
    staged = staged.withColumn("plen", TK.common_prefix_len(F.col("p"), F.col("input_ids")))
    staged = staged.withColumn("labels", TK.loss_labels(F.col("input_ids"), F.col("mask"), F.col("plen")))
    return staged.select(
        "example_id",
        F.aggregate("mask", F.lit(0), lambda a, x: a + x).alias("n_tokens"),
        F.col("plen").alias("prompt_len"),
        F.size(F.filter("labels", lambda x: x != C.IGNORE_INDEX)).alias("n_label_tokens"),
        F.md5(_join_ints(F.col("input_ids"))).alias("ids_md5"),
        F.md5(_join_ints(F.col("labels"))).alias("labels_md5"),
        *([] if max_length is None else ["n_dropped"]),
    )


def _side_sql(side: str) -> str:
    comp = f"(CASE WHEN starts_with({side}, prompt) AND length(prompt) > 0 THEN substr({side}, length(prompt) + 1) ELSE {side} END)"
    p = O.token_ids("prompt")
    j = O.token_ids(f"(prompt || {comp})")
    return f"""SELECT example_id, {O.q(side)} AS side, (starts_with({side}, prompt) AND length(prompt) > 0) AS prefix_dropped,
  ({O.common_prefix_len(p, j)} = len({p})) AS tokens_aligned, CAST(len({p}) AS INTEGER) AS n_prompt_tokens,
  md5({comp}) AS completion_md5 FROM _pairs"""


@register(
    "boundary_audit",
    O.with_ctes(
        O.RESPONSES_CTE + _judged_best_sql() + ",\n_pairs AS (" + _teacher_pairs_sql_body() + ")",
        _side_sql("chosen") + "\nUNION ALL\n" + _side_sql("rejected"),
    ),
    "T4 prompt/completion boundary alignment for both sides of every pair",
)
def boundary_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _teacher_pairs_df(spark, sf_dir)
    sides = pairs.select(
        "example_id", "prompt",
        F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("text")) for s in ("chosen", "rejected")])).alias("s"),
    ).select("example_id", "prompt", "s.side", "s.text")
    a = TK.align_completion(F.col("prompt"), F.col("text"))
    return sides.select(
        "example_id", "side", a["prefix_dropped"].alias("prefix_dropped"), a["tokens_aligned"].alias("tokens_aligned"),
        a["n_prompt_tokens"].alias("n_prompt_tokens"), F.md5(a["completion"]).alias("completion_md5"),
    )


@register(
    "token_budget",
    O.with_ctes(
        O.RESPONSES_CTE,
        f"""SELECT example_id, CAST(len({O.pieces('prompt')}) AS INTEGER) AS prompt_tokens,
                  len({O.pieces('prompt')}) > 512 AS truncated,
                  CAST(least(len({O.pieces('prompt')}), 512) AS INTEGER) AS kept_tokens,
                  CAST(len({O.pieces(O.rank_prompt(C.RANK_SYSTEM, 'instruction', 'input', O.candidate_block('responses')))}) AS INTEGER) AS rank_prompt_tokens
           FROM responses""",
    ),
    "T5 prompt token counts, 512-token truncation flag, judge prompt length",
)
def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = TB.responses(spark, sf_dir)
    s = r.select(
        "example_id",
        TK.count_tokens("prompt").alias("prompt_tokens"),
        TK.count_tokens(T.rank_prompt("instruction", "input", "responses")).alias("rank_prompt_tokens"),
    )
    return s.select(
        "example_id", "prompt_tokens", (F.col("prompt_tokens") > C.PROMPT_TOKEN_CAP).alias("truncated"),
        F.least("prompt_tokens", F.lit(C.PROMPT_TOKEN_CAP)).alias("kept_tokens"), "rank_prompt_tokens",
    )


@register(
    "batch_plan",
    O.with_ctes(
        O.EXAMPLES_CTE,
        f"""SELECT batch_id, count(*) AS n_rows, CAST(max(k) AS INTEGER) AS padded_width,
                  CAST(max(k) * count(*) AS BIGINT) AS padded_tokens, CAST(sum(k) AS BIGINT) AS real_tokens,
                  CAST(max(k) * count(*) - sum(k) AS BIGINT) AS pad_waste
           FROM (SELECT example_id // 8 AS batch_id, least(len({O.pieces(O.prompt('instruction', 'input'))}), 512) AS k FROM examples)
           GROUP BY batch_id""",
    ),
    "N5/N6 fixed-size generation batches in input order and their left-padded width (capped at 512)",
)
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = TB.examples(spark, sf_dir)
    k = F.least(TK.count_tokens(T.format_prompt("instruction", "input")), F.lit(C.PROMPT_TOKEN_CAP))
    b = ex.select(batch_ids("example_id", C.GEN_BATCH_SIZE).alias("batch_id"), k.alias("k"))
    g = b.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("k").alias("padded_width"), F.sum("k").alias("real_tokens"))
    return g.select(
        "batch_id", "n_rows", "padded_width",
        (F.col("padded_width") * F.col("n_rows")).alias("padded_tokens"),
        "real_tokens",
        (F.col("padded_width") * F.col("n_rows") - F.col("real_tokens")).alias("pad_waste"),
    )


@register(
    "generated_tokens",
    O.with_ctes(
        O.EXAMPLES_CTE + f""",
_p AS (SELECT example_id, {O.token_ids(O.prompt('instruction', 'input'))} AS p, {O.token_ids('output')} AS o FROM examples),
_w AS (SELECT *, max(least(len(p), {C.PROMPT_TOKEN_CAP})) OVER (PARTITION BY example_id // {C.GEN_BATCH_SIZE}) AS width FROM _p)""",
        "SELECT example_id, CAST(width AS INTEGER) AS padded_width, CAST(len(o) AS INTEGER) AS n_new, md5(array_to_string(o, ',')) AS new_md5 FROM _w",
    ),
    "T6 new tokens of left-padded batches start at the batch's padded width, not at the prompt's own length",
)
def generated_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model output as a batch holds it: the prompt (cut at the cap) left-padded to its batch's width, then the new tokens."""
    ex = TB.examples(spark, sf_dir).select(
        "example_id", batch_ids("example_id", C.GEN_BATCH_SIZE).alias("batch_id"),
        TK.truncate_prompt(TK.token_ids(T.format_prompt("instruction", "input")))[0].alias("p"), TK.token_ids("output").alias("o"),
    )
    widths = ex.groupBy("batch_id").agg(F.max(F.size("p")).alias("padded_width"))
    rows = ex.join(widths, "batch_id")
    padded = F.concat(F.array_repeat(F.lit(TK.PAD_ID), F.col("padded_width") - F.size("p")), "p", "o")
    new = TK.new_tokens(padded, F.col("padded_width"))
    return rows.select("example_id", "padded_width", F.size(new).alias("n_new"), F.md5(_join_ints(new)).alias("new_md5"))
