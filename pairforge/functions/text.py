"""Prompt and completion templating as native Column expressions.

All functions take and return ``Column``s, so they stay inside whole-stage codegen and
Catalyst can prune and push around them.  Null handling follows the reference: an absent
``input`` behaves as the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge import constants as C

# Python's str.strip() removes every code point for which str.isspace() is true.  Trimming by
# a character list is linear in the text, whatever runs of white space it holds.
_WS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(c) -> Column:
    """Unicode whitespace strip on both ends (``str.strip``)."""
    return F.btrim(_c(c), F.lit(_WS))


def lstrip_ws(c) -> Column:
    """W1 left half (``str.lstrip``)."""
    return F.ltrim(_c(c), F.lit(_WS))


def rstrip_ws(c) -> Column:
    return F.rtrim(_c(c), F.lit(_WS))


def or_empty(c) -> Column:
    """P5: ``x or ""``."""
    return F.coalesce(_c(c), F.lit(""))


def format_prompt(instruction, input_text=None) -> Column:
    """``"Human: {instruction} {input} "`` (empty input leaves two spaces)."""
    inp = or_empty(input_text) if input_text is not None else F.lit("")
    return F.concat(F.lit(C.HUMAN_PREFIX), _c(instruction), F.lit(" "), inp, F.lit(" "))


def format_completion(output) -> Column:
    """``"Assistant: {output}"``."""
    return F.concat(F.lit(C.ASSISTANT_PREFIX + " "), _c(output))


def strip_assistant_prefix(text) -> Column:
    """Drop a leading ``Assistant:`` once (exact case, position 0), then left-strip."""
    t = _c(text)
    return F.when(t.startswith(C.ASSISTANT_PREFIX), lstrip_ws(F.substr(t, F.lit(len(C.ASSISTANT_PREFIX) + 1)))).otherwise(t)


def ensure_assistant_prefix(text) -> Column:
    """Strip both ends, prepend ``Assistant: `` unless already present."""
    t = strip_ws(text)
    return F.when(t.startswith(C.ASSISTANT_PREFIX), t).otherwise(F.concat(F.lit(C.ASSISTANT_PREFIX + " "), t))


def user_text(instruction, input_text) -> Column:
    """Instruction, plus ``"\\n\\nInput: " + input`` when input is non-empty."""
    inp = or_empty(input_text)
    return F.when(inp != "", F.concat(_c(instruction), F.lit(C.INPUT_JOIN), inp)).otherwise(_c(instruction))


def _candidate_block(responses: Column) -> Column:
    # "\n".join([..., "\n[1]\nA", "\n[2]\nB", ...]) contributes "\n\n[i]\n" + text per candidate.
    return F.array_join(
        F.transform(responses, lambda x, i: F.concat(F.lit("\n\n["), (i + 1).cast("string"), F.lit("]\n"), x)), ""
    )


def rank_prompt_from_block(system: str, user: Column, block: Column) -> Column:
    return F.concat(
        F.lit(system + "\n\n" + C.INSTRUCTION_HEADER),
        user,
        F.lit("\n\n" + C.CANDIDATES_HEADER),
        block,
        F.lit("\n" + C.RETURN_JSON),
    )


def rank_prompt(instruction, input_text, responses) -> Column:
    """Single-best rank prompt over an ordered candidate array."""
    return rank_prompt_from_block(C.RANK_SYSTEM, user_text(instruction, input_text), _candidate_block(_c(responses)))


def rank_best_worst_prompt(instruction, input_text, responses) -> Column:
    """P7 with two literal replacements over the whole text (user text included)."""
    out = rank_prompt(instruction, input_text, responses)
    for old, new in C.BEST_WORST_REPLACEMENTS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def blind_rank_prompt(instruction, input_text, labelled_responses) -> Column:
    """Three-way prompt; ``labelled_responses`` is already in label order 1..n."""
    return rank_prompt_from_block(
        C.BLIND_RANK_SYSTEM, user_text(instruction, input_text), _candidate_block(_c(labelled_responses))
    )


def sft_text(instruction, input_text, output, eos: str = C.EOS_TEXT) -> Column:
    """P10: ``"Human: {i} {in} Assistant: " + output`` with EOS appended unless present."""
    out = _c(output)
    completion = F.when(out.endswith(eos), out).otherwise(F.concat(out, F.lit(eos))) if eos else out
    return F.concat(sft_prompt(instruction, input_text), completion)


def sft_prompt(instruction, input_text) -> Column:
    return F.concat(
        F.lit(C.HUMAN_PREFIX), _c(instruction), F.lit(" "), or_empty(input_text), F.lit(" " + C.ASSISTANT_PREFIX + " ")
    )


def chat_messages(instruction, input_text, system: str = C.TEACHER_SYSTEM) -> Column:
    """``[{role: system, content}, {role: user, content}]``."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), user_text(instruction, input_text).alias("content")),
    )


def flatten_chat(messages, add_generation_prompt: bool = True) -> Column:
    """Render a message array with ChatML markers (the format the default judge family uses)."""
    body = F.array_join(
        F.transform(
            _c(messages),
            lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n")),
        ),
        "",
    )
    return F.concat(body, F.lit("<|im_start|>assistant\n")) if add_generation_prompt else body


def teacher_chosen(raw_text) -> Column:
    """Chosen side of a teacher pair: strip, drop one ``Assistant:`` prefix, re-prefix (P2∘P3∘W1)."""
    return format_completion(strip_assistant_prefix(strip_ws(raw_text)))
