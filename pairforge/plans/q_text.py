"""Registered queries: templating and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge import oracle as O
from pairforge.functions import stub_models as S
from pairforge.functions import text as T
from pairforge.plans.catalog import register
from pairforge.sources import tables as TB

SEP = "\x1f"  # unit separator used to flatten arrays into one comparable string


def _ex(spark, sf_dir) -> DataFrame:
    return TB.examples(spark, sf_dir)


@register(
    "position_ids",
    O.with_ctes(O.EXAMPLES_CTE, "SELECT example_id, conv_id, turn FROM examples"),
    "N1 dense 0-based ids in (conv_id, turn) order without a single-task window",
)
def position_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ex(spark, sf_dir).select("example_id", "conv_id", "turn")


@register(
    "prompt_template",
    O.with_ctes(O.EXAMPLES_CTE, f"SELECT example_id, {O.prompt('instruction', 'input')} AS prompt FROM examples"),
    "P1/P5 prompt template with trailing space; empty input leaves two spaces",
)
def prompt_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ex(spark, sf_dir).select("example_id", T.format_prompt("instruction", "input").alias("prompt"))


@register(
    "completion_template",
    O.with_ctes(O.EXAMPLES_CTE, "SELECT example_id, 'Assistant: ' || output AS completion FROM examples"),
    "P2 completion template",
)
def completion_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ex(spark, sf_dir).select("example_id", T.format_completion("output").alias("completion"))


_RAW_SQL = O.teacher_reply("example_id", "output")


@register(
    "strip_prefix",
    O.with_ctes(
        O.EXAMPLES_CTE,
        f"SELECT example_id, {O.strip_prefix('raw')} AS stripped FROM (SELECT example_id, {_RAW_SQL} AS raw FROM examples)",
    ),
    "P3 drop one leading 'Assistant:' at position 0 then left-strip, over teacher-style replies",
)
def strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.teacher_reply(F.col("example_id"), F.col("output"))
    return _ex(spark, sf_dir).select("example_id", T.strip_assistant_prefix(raw).alias("stripped"))


@register(
    "ensure_prefix",
    O.with_ctes(
        O.EXAMPLES_CTE,
        f"SELECT example_id, {O.ensure_prefix('raw')} AS text FROM (SELECT example_id, {_RAW_SQL} AS raw FROM examples)",
    ),
    "P4 Unicode strip then prefix 'Assistant: ' unless present",
)
def ensure_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.teacher_reply(F.col("example_id"), F.col("output"))
    return _ex(spark, sf_dir).select("example_id", T.ensure_assistant_prefix(raw).alias("text"))


@register(
    "user_text",
    O.with_ctes(O.EXAMPLES_CTE, f"SELECT example_id, {O.user_text('instruction', 'input')} AS user_text FROM examples"),
    "P6 judge user text: instruction plus input block when input is non-empty",
)
def user_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ex(spark, sf_dir).select("example_id", T.user_text("instruction", "input").alias("user_text"))


@register(
    "sft_text",
    O.with_ctes(
        O.EXAMPLES_CTE,
        f"""SELECT example_id, 'Human: ' || instruction || ' ' || input || ' Assistant: ' ||
          CASE WHEN ends_with(output, {O.q(C.EOS_TEXT)}) THEN output ELSE output || {O.q(C.EOS_TEXT)} END AS text
        FROM examples""",
    ),
    "P10 SFT training text with EOS appended once",
)
def sft_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ex(spark, sf_dir).select("example_id", T.sft_text("instruction", "input", "output").alias("text"))


_CHAT_SQL = (
    "'<|im_start|>system' || chr(10) || {sys} || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || {user}"
    " || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"
)


@register(
    "chat_messages",
    O.with_ctes(
        O.EXAMPLES_CTE,
        "SELECT example_id, 'system' || chr(31) || 'user' AS roles, "
        + _CHAT_SQL.format(sys=O.q(C.TEACHER_SYSTEM), user=O.user_text("instruction", "input"))
        + " AS chat_text FROM examples",
    ),
    "P13 chat message array (system + user) and its ChatML rendering",
)
def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = T.chat_messages("instruction", "input")
    return _ex(spark, sf_dir).select(
        "example_id",
        F.array_join(F.transform(msgs, lambda m: m["role"]), SEP).alias("roles"),
        T.flatten_chat(msgs).alias("chat_text"),
    )


@register(
    "candidates_regroup",
    O.with_ctes(
        O.RESPONSES_CTE,
        "SELECT example_id, CAST(len(responses) AS INTEGER) AS n_candidates, array_to_string(responses, chr(31)) AS candidates, prompt FROM responses",
    ),
    "A7 regroup flat samples into an ordered list per prompt (order from the sample index), with P4 and P1",
)
def candidates_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = TB.responses(spark, sf_dir)
    return r.select(
        "example_id",
        F.size("responses").alias("n_candidates"),
        F.array_join("responses", SEP).alias("candidates"),
        "prompt",
    )


_BLOCK = O.candidate_block("responses")


@register(
    "judge_prompt",
    O.with_ctes(
        O.RESPONSES_CTE,
        f"SELECT example_id, {O.rank_prompt(C.RANK_SYSTEM, 'instruction', 'input', _BLOCK)} AS rank_prompt FROM responses",
    ),
    "P7 single-best rank prompt over the candidates",
)
def judge_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = TB.responses(spark, sf_dir)
    return r.select("example_id", T.rank_prompt("instruction", "input", "responses").alias("rank_prompt"))


@register(
    "judge_prompt_best_worst",
    O.with_ctes(
        O.RESPONSES_CTE,
        f"SELECT example_id, {O.best_worst_prompt(O.rank_prompt(C.RANK_SYSTEM, 'instruction', 'input', _BLOCK))} AS rank_prompt FROM responses",
    ),
    "P8 best/worst prompt via two literal replacements over the whole text",
)
def judge_prompt_best_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = TB.responses(spark, sf_dir)
    return r.select("example_id", T.rank_best_worst_prompt("instruction", "input", "responses").alias("rank_prompt"))


def _echo_sql(j: int) -> str:
    p = O.strip(O.prompt("instruction", "input"))
    return O.ensure_prefix(f"array_to_string(list_transform(range({j + 1}), lambda _x: {p}), ' ')")


@register(
    "generate_candidates",
    O.with_ctes(
        O.EXAMPLES_CTE,
        f"""SELECT example_id, {O.prompt('instruction', 'input')} AS prompt, 4 AS n_candidates,
                  {_echo_sql(0)} || chr(31) || {_echo_sql(1)} || chr(31) || {_echo_sql(2)} || chr(31) || {_echo_sql(3)} AS candidates
           FROM examples""",
    ),
    "R1/A7/P4 multi-sample generation through the mapInPandas model hook, regrouped by sample index",
)
def generate_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.operators.infer import PandasModel, generate_long
    from pairforge.operators.regroup import regroup_ordered

    ex = _ex(spark, sf_dir).select("example_id", T.format_prompt("instruction", "input").alias("prompt"))
    model = PandasModel(S.STUB_GENERATOR_ID, S.echo_sampler_factory, batch_size=C.GEN_BATCH_SIZE)
    long = generate_long(ex, model, "example_id", "prompt", C.NUM_SAMPLES, carry=("prompt",))
    long = long.filter(F.col("error").isNull()).withColumn("text", T.ensure_assistant_prefix("text"))
    out = regroup_ordered(long, "example_id", "sample_index", "text", "responses", extra={"prompt": F.any_value("prompt")})
    return out.select(
        "example_id", "prompt", F.size("responses").alias("n_candidates"), F.array_join("responses", SEP).alias("candidates")
    )
