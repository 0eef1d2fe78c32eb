"""Token arrays: tokenise, pad, loss masks, prompt/completion boundaries.

The default tokeniser is native: pieces are ``' ?[^ws]+'`` (a word with at most one
leading space) or a whitespace run, ids are a hash of the piece, and a trailing end-of-text
marker becomes the special id.  It is lossless (pieces concatenate back to the text) and
runs inside codegen.  A learned tokeniser plugs in through ``pandas_tokenizer`` (a vectorised
Arrow UDF); everything downstream works on ``ARRAY<INT>`` either way.

All array manipulation (truncate, pad, mask, common prefix) is native higher-order
functions; no per-row Python.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge import constants as C

# Whitespace as Java's and RE2's ASCII \s differ on \x0B, the class is spelled out.
ASCII_WS = r"\t\n\x0B\f\r "
PIECE = rf" ?[^{ASCII_WS}]+|[{ASCII_WS}]+"
VOCAB = 50256
EOS_ID = VOCAB  # end-of-text; also the pad id, as in the reference's tokenizer setup
PAD_ID = EOS_ID


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pieces(text) -> Column:
    """Token strings of ``text`` (no special-token handling)."""
    return F.regexp_extract_all(_c(text), F.lit(PIECE), 0)


def piece_id(piece: Column) -> Column:
    return F.pmod(F.conv(F.substr(F.md5(piece), F.lit(1), F.lit(8)), 16, 10).cast("bigint"), F.lit(VOCAB)).cast("int")


def token_ids(text, eos: str = C.EOS_TEXT) -> Column:
    """T1 (tokenise): ids of ``text``; a trailing ``eos`` marker becomes ``EOS_ID``."""
    t = _c(text)
    body_len = F.length(t) - F.lit(len(eos))
    has_eos = t.endswith(eos)
    body = F.when(has_eos, F.substr(t, F.lit(1), body_len)).otherwise(t)
    ids = F.transform(pieces(body), piece_id)
    return F.when(has_eos, F.concat(ids, F.array(F.lit(EOS_ID)))).otherwise(ids)


def count_tokens(text) -> Column:
    return F.size(pieces(text))


def truncate(ids: Column, max_length: int | None) -> tuple[Column, Column]:
    """T1 (truncate): the first ``max_length`` tokens (all of them if it is None) and the number dropped."""
    if max_length is None:
        return ids, F.lit(0)
    return F.slice(ids, 1, max_length), F.greatest(F.size(ids) - F.lit(max_length), F.lit(0))


def pad_right(ids: Column, length: int, pad_id: int = PAD_ID) -> tuple[Column, Column]:
    """T1 (pad): ``(input_ids, attention_mask)`` of at least ``length``; longer ids stay whole."""
    n = F.size(ids)
    pad = F.greatest(F.lit(length) - n, F.lit(0))
    input_ids = F.concat(ids, F.array_repeat(F.lit(pad_id), pad))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), pad))
    return input_ids, mask


def common_prefix_len(prefix: Column, ids: Column) -> Column:
    """Length of the common prefix of ``prefix`` and ``ids`` (capped at ``size(prefix)``)."""
    eq = F.zip_with(prefix, F.slice(ids, 1, F.size(prefix)), lambda a, b: a.eqNullSafe(b))
    first_diff = F.array_position(eq, F.lit(False))
    return F.when(first_diff > 0, first_diff - 1).otherwise(F.size(prefix)).cast("int")


def loss_labels(input_ids: Column, attention_mask: Column, prompt_len: Column, ignore: int = C.IGNORE_INDEX) -> Column:
    """Ignore prompt positions and padding — by the mask, never by pad id (EOS = pad)."""
    return F.transform(
        input_ids,
        lambda x, i: F.when((i < prompt_len) | (F.get(attention_mask, i) == 0), F.lit(ignore)).otherwise(x),
    )


def sft_features(prompt: Column, full_text: Column, max_length: int | None = None) -> dict[str, Column]:
    """T1-T3 over a prompt and the full training text, whole or cut to ``max_length`` (``n_dropped`` counts the rest)."""
    kept, n_dropped = truncate(token_ids(full_text), max_length)
    input_ids, mask = pad_right(kept, C.SFT_MAX_LENGTH if max_length is None else max_length)
    plen = common_prefix_len(token_ids(prompt), input_ids)
    return {"input_ids": input_ids, "attention_mask": mask, "prompt_len": plen, "labels": loss_labels(input_ids, mask, plen), "n_dropped": n_dropped}


def align_completion(prompt: Column, completion: Column) -> dict[str, Column]:
    """T4: drop a repeated prompt prefix (a), then report whether the prompt's tokens are a
    prefix of the joint tokens (b).  For this lossless, prefix-stable tokeniser, the
    decode-search of step (c) finds a cut exactly when (b) holds, so the text is never
    altered beyond (a) (Q26)."""
    dropped = completion.startswith(prompt) & (F.length(prompt) > 0)
    comp = F.when(dropped, F.substr(completion, F.length(prompt) + 1, F.lit(1 << 30))).otherwise(completion)
    p_ids = token_ids(prompt)
    j_ids = token_ids(F.concat(prompt, comp))
    aligned = common_prefix_len(p_ids, j_ids) == F.size(p_ids)
    return {"completion": comp, "prefix_dropped": dropped, "tokens_aligned": aligned, "n_prompt_tokens": F.size(p_ids)}


def truncate_prompt(ids: Column, cap: int = C.PROMPT_TOKEN_CAP) -> tuple[Column, Column]:
    """T5: keep the first ``cap`` tokens; flag truncation."""
    return F.slice(ids, 1, cap), F.size(ids) > F.lit(cap)


def new_tokens(output_ids: Column, padded_width: Column) -> Column:
    """Generated tokens start at the padded input width (not at the mask sum)."""
    return F.slice(output_ids, padded_width + 1, F.greatest(F.size(output_ids) - padded_width, F.lit(0)))


def pandas_tokenizer(encode: Callable[[list[str]], list[list[int]]]):
    """Wrap a batch encoder (e.g. a learned BPE) as a vectorised ``ARRAY<INT>`` UDF."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _encode(texts: pd.Series) -> pd.Series:
        return pd.Series(encode(texts.fillna("").tolist()))

    return _encode
