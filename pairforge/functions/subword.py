"""Boundary alignment with a learned subword tokeniser (T4).

``align_learned`` does what the native ``tokens.align_completion`` cannot: a learned tokeniser may merge
characters across the end of the prompt, so the prompt's own tokens need not be a prefix of the joint
tokens.  Then the joint tokens are cut where their first part decodes to the prompt.  That place is found
by the tokens' character offsets (a binary search and one decoding) instead of by decoding every prefix.

Branches, by which a row's completion was made (after a repeated prompt prefix was dropped from it):

* ``b``  the prompt's tokens are a prefix of the joint tokens: unchanged;
* ``c``  cut at the joint token that ends with the prompt: what the remaining tokens decode to;
* ``d``  no such token: unchanged.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ALIGNED = "completion string, prefix_dropped boolean, branch string, n_prompt_tokens int, n_joint_tokens int, cut int"


@lru_cache(maxsize=4)
def load(path: str):
    """The tokeniser of a file, once per Python worker; its offsets keep white space."""
    from tokenizers import Tokenizer, processors

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    tok.post_processor = processors.ByteLevel(trim_offsets=False)
    return tok


def offset_cut(offsets: list[tuple[int, int]], width: int) -> range:
    """The numbers of leading tokens that end exactly at character ``width`` with no later token
    before it; ``offsets`` are the tokens' character spans in order."""
    if width == 0:
        return range(0, 1)
    ends = [e for _, e in offsets]
    first = bisect_left(ends, width)
    last = first
    while last < len(ends) and ends[last] == width:
        last += 1
    # Tokens that share a character have the same span: a later one that starts before it blocks the cut.
    starts_late = last >= len(offsets) or offsets[last][0] >= width
    return range(first + 1, last + 1) if starts_late else range(0)


def decode_cut(tok, ids: list[int], offsets: list[tuple[int, int]], prompt: str, joint: str) -> int | None:
    """The smallest number of leading tokens that decode to ``prompt``, or None."""
    for p in offset_cut(offsets, len(prompt)):
        if tok.decode(ids[:p], skip_special_tokens=False) == prompt:
            return p
    # Offsets say nothing about what a lossy tokeniser decodes to, nor where U+FFFD may stand for a part of
    # a character; only then every prefix is tried.
    if "�" in prompt or tok.decode(ids, skip_special_tokens=False) != joint:
        return next((p for p in range(len(ids) + 1) if tok.decode(ids[:p], skip_special_tokens=False) == prompt), None)
    return None


def align_batch(tok, prompts: list[str], completions: list[str]) -> list[tuple]:
    dropped = [c.startswith(p) for p, c in zip(prompts, completions, strict=True)]
    rest = [c[len(p) :] if d else c for p, c, d in zip(prompts, completions, dropped, strict=True)]
    out = []
    for prompt, completion, drop in zip(prompts, rest, dropped, strict=True):
        text = prompt + completion
        # one row's encodings at a time: an encoding takes a hundred bytes a token and more
        head, whole = tok.encode(prompt, add_special_tokens=False).ids, tok.encode(text, add_special_tokens=False)
        ids, n = whole.ids, len(head)
        branch, cut = "b", n
        if ids[:n] != head:
            cut = decode_cut(tok, ids, whole.offsets, prompt, text)
            branch = "d" if cut is None else "c"
            if cut is not None:
                completion = tok.decode(ids[cut:], skip_special_tokens=True)
        out.append((completion, drop and prompt != "", branch, n, len(ids), cut))
    return out


def align_learned(path: str, prompt: Column, completion: Column) -> Column:
    """T4 as a struct (``ALIGNED``) per row; null texts are empty.  ``path`` is a tokeniser file that
    every executor can read at the same place."""

    @F.pandas_udf(ALIGNED)
    def run(prompts: pd.Series, completions: pd.Series) -> pd.DataFrame:
        rows = align_batch(load(path), prompts.fillna("").tolist(), completions.fillna("").tolist())
        frame = pd.DataFrame(rows, columns=["completion", "prefix_dropped", "branch", "n_prompt_tokens", "n_joint_tokens", "cut"])
        return frame.astype({"n_prompt_tokens": "int32", "n_joint_tokens": "int32", "cut": "Int32"})

    return run(prompt, completion)
