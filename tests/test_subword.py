"""Boundary alignment with a learned tokeniser (T4): against decoding every prefix."""

import random

import pytest
from pyspark.sql import functions as F

from pairforge.functions import subword as SW

public_tokenizers = pytest.importorskip("public_tokenizers")
FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def every_prefix(tok, prompt, completion):
    if completion.startswith(prompt):
        completion = completion[len(prompt) :]
    own = tok.encode(prompt, add_special_tokens=False).ids
    ids = tok.encode(prompt + completion, add_special_tokens=False).ids
    if ids[: len(own)] == own:
        return completion, "b", len(own)
    for p in range(len(ids) + 1):
        if tok.decode(ids[:p], skip_special_tokens=False) == prompt:
            return tok.decode(ids[p:], skip_special_tokens=True), "c", p
    return completion, "d", None


def cases():
    rng = random.Random(4)
    words = ["the", "understanding", "unhappiness", "naïve", "théâtre", "日本語", "", "\n\n", "ab", "\t", "x", "👍🏽", "�", "don't", "12345"]
    out = [("", ""), ("", "a"), ("a", ""), ("same", "same"), ("a b ", "a b c"), ("Q\n\n", "Answer"), ("x�", "y"), ("e", "́"), ("👍", "🏽 ok"), ("long " * 2000, "tail " * 2000)]
    for _ in range(1500):
        text = " ".join(rng.choice(words) for _ in range(4)) if rng.random() < 0.6 else "".join(rng.choice("abcé \n日") for _ in range(10))
        k = rng.randint(0, len(text))
        out.append((text[:k], (text[:k] if rng.random() < 0.1 else "") + text[k:]))
    return out


@pytest.mark.parametrize("name", FILES)
def test_equals_decoding_every_prefix(name):
    tok = SW.load(public_tokenizers.path(name))
    rows = cases()
    got = SW.align_batch(tok, [p for p, _ in rows], [c for _, c in rows])
    assert [(g[0], g[2], g[5]) for g in got] == [every_prefix(tok, p, c) for p, c in rows]
    assert {"b", "d"} <= {g[2] for g in got} and (name != FILES[0] or sum(g[2] == "c" for g in got) >= 5)


def test_offsets_find_the_cut():
    spans = [(0, 2), (2, 5), (5, 6), (5, 6), (6, 6), (6, 9)]
    assert list(SW.offset_cut(spans, 5)) == [2] and list(SW.offset_cut(spans, 6)) == [3, 4, 5] and list(SW.offset_cut(spans, 9)) == [6]
    assert not SW.offset_cut(spans, 3) and not SW.offset_cut([(0, 1), (1, 2), (1, 2)], 1).stop - 2 and list(SW.offset_cut(spans, 0)) == [0]


def test_column_with_nulls(spark):
    rows = [("Q\n\n", "Answer"), ("a ", "b"), (None, "x"), ("p", None), ("p", "p q")]
    df = spark.createDataFrame(rows, "prompt string, completion string")
    got = df.select(SW.align_learned(public_tokenizers.path(FILES[0]), F.col("prompt"), F.col("completion")).alias("a")).select("a.*").collect()
    assert [(r.completion, r.prefix_dropped, r.branch) for r in got] == [("Answer", False, "c"), ("b", False, "d"), ("x", False, "b"), ("", False, "b"), (" q", True, "b")]
    assert got[0].cut == 3 and got[1].cut is None


def test_query_covers_both_sides_of_every_pair(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL

    tok = SW.load(public_tokenizers.path(FILES[0]))
    pairs = E.queries()["pairs_teacher"](spark, SF_SMALL).collect()
    got = {(r.example_id, r.side): r for r in E.queries()["boundary_learned"](spark, SF_SMALL).collect()}
    import hashlib

    assert len(got) == 2 * len(pairs)
    for p in pairs:
        for side in ("chosen", "rejected"):
            text, branch, cut = every_prefix(tok, p.prompt, p[side])
            r = got[p.example_id, side]
            assert (r.branch, r.cut, r.completion_md5) == (branch, cut, hashlib.md5(text.encode()).hexdigest())


def test_one_row_is_encoded_at_a_time():
    """a batch's encodings together take a worker's memory by its rows; one row's are held at a time."""

    class OneByOne:
        def __init__(self, tok):
            self.tok = tok

        def encode(self, text, **how):
            return self.tok.encode(text, **how)

        def decode(self, ids, **how):
            return self.tok.decode(ids, **how)

    tok, rows = SW.load(public_tokenizers.path(FILES[0])), cases()[:200]
    prompts, completions = [p for p, _ in rows], [c for _, c in rows]
    assert SW.align_batch(OneByOne(tok), prompts, completions) == SW.align_batch(tok, prompts, completions)
