"""Templates (FIXTURES §4) and the W1 whitespace strip over all 29 code points."""

from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge.functions import text as T

WS = [chr(c) for c in list(range(0x09, 0x0E)) + list(range(0x1C, 0x21)) + [0x85, 0xA0, 0x1680]
      + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_prompt_template(spark):
    assert _one(spark, T.format_prompt(F.lit("Do x"), F.lit(""))) == "Human: Do x  "
    assert _one(spark, T.format_prompt(F.lit("Do x"), F.lit("y"))) == "Human: Do x y "
    assert _one(spark, T.format_prompt(F.lit("Do x"), F.lit(None).cast("string"))) == "Human: Do x  "


def test_strip_prefix(spark):
    assert _one(spark, T.strip_assistant_prefix(F.lit("Assistant:  hi"))) == "hi"
    assert _one(spark, T.strip_assistant_prefix(F.lit(" Assistant: hi"))) == " Assistant: hi"
    assert _one(spark, T.strip_assistant_prefix(F.lit("Assistant: Assistant: a"))) == "Assistant: a"


def test_ensure_prefix(spark):
    assert _one(spark, T.ensure_assistant_prefix(F.lit("  hi \n"))) == "Assistant: hi"
    assert _one(spark, T.ensure_assistant_prefix(F.lit("　Assistant: x "))) == "Assistant: x"


def test_whitespace_29(spark):
    assert len(WS) == 29 and all(c.isspace() for c in WS)
    rows = [(i, c + "a b" + c) for i, c in enumerate(WS)]
    df = spark.createDataFrame(rows, "i int, t string")
    got = [r.v for r in df.select("i", T.strip_ws("t").alias("v")).orderBy("i").collect()]
    assert got == ["a b"] * 29
    mixed = "".join(WS) + "x" + "".join(reversed(WS))
    assert _one(spark, T.strip_ws(F.lit(mixed))) == mixed.strip()
    assert _one(spark, T.lstrip_ws(F.lit(mixed))) == mixed.lstrip()


def test_strip_is_linear_in_inner_white_space(spark):
    text = F.concat(F.lit(" x"), F.repeat(F.lit(" "), 1_000_000), F.lit("y "))
    assert _one(spark, F.length(T.strip_ws(text))) == 1_000_002


def test_rank_prompt_matches_python_join(spark):
    df = spark.createDataFrame([("Q", "ctx", ["A", "B"]), ("Q", "", [])], "i string, inp string, r array<string>")
    got = [r.v for r in df.select(T.rank_prompt("i", "inp", "r").alias("v")).collect()]

    assert got == [
        C.RANK_SYSTEM + "\n\nInstruction:\nQ\n\nInput: ctx\n\nCandidate responses:\n\n[1]\nA\n\n[2]\nB\n\nReturn JSON only.",
        C.RANK_SYSTEM + "\n\nInstruction:\nQ\n\nCandidate responses:\n\nReturn JSON only.",
    ]
    bw = spark.range(1).select(T.rank_best_worst_prompt(F.lit("Q"), F.lit(""), F.array(F.lit("A"))).alias("v")).first().v
    assert "pick the BEST and WORST response" in bw and "best and worst must be different indices." in bw


def test_sft_text_eos_once(spark):
    a = _one(spark, T.sft_text(F.lit("i"), F.lit(""), F.lit("o")))
    b = _one(spark, T.sft_text(F.lit("i"), F.lit(""), F.lit("o" + C.EOS_TEXT)))
    assert a == b == "Human: i  Assistant: o" + C.EOS_TEXT
