"""Token arrays (T1-T6) on the FIXTURES §4 loss-mask example and boundary cases."""

from pyspark.sql import functions as F

from pairforge.functions import tokens as TK


def _arr(xs):
    return F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<int>")


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_loss_mask_fixture(spark):
    ids, mask = TK.pad_right(_arr([5, 6, 7, 0]), 6, pad_id=0)
    plen = TK.common_prefix_len(_arr([5, 6]), ids)
    assert list(_one(spark, ids)) == [5, 6, 7, 0, 0, 0]
    assert list(_one(spark, mask)) == [1, 1, 1, 1, 0, 0]
    assert _one(spark, plen) == 2
    assert list(_one(spark, TK.loss_labels(ids, mask, plen))) == [-100, -100, 7, 0, -100, -100]


def test_common_prefix_cases(spark):
    cases = [([1, 2], [1, 2, 3], 2), ([1, 2], [1, 9, 3], 1), ([4], [1], 0), ([1, 2, 3], [1, 2], 2), ([], [1], 0)]
    for p, ids, want in cases:
        assert _one(spark, TK.common_prefix_len(_arr(p), _arr(ids))) == want


def test_tokeniser_is_lossless_and_marks_eos(spark):
    text = "Human: a  b\nc Assistant: d"
    pieces = _one(spark, TK.pieces(F.lit(text)))
    assert "".join(pieces) == text
    ids = _one(spark, TK.token_ids(F.lit("hi there<|endoftext|>")))
    assert ids[-1] == TK.EOS_ID and len(ids) == 3


def test_truncate_and_new_tokens(spark):
    kept, flag = TK.truncate_prompt(_arr(list(range(600))), 512)
    assert len(_one(spark, kept)) == 512 and _one(spark, flag) is True
    assert list(_one(spark, TK.new_tokens(_arr([0, 0, 5, 6, 7, 8]), F.lit(3)))) == [6, 7, 8]


def test_align_completion(spark):
    a = TK.align_completion(F.lit("Human: x  "), F.lit("Human: x  Assistant: y"))
    assert _one(spark, a["completion"]) == "Assistant: y"
    assert _one(spark, a["prefix_dropped"]) is True
    assert _one(spark, a["tokens_aligned"]) is True
    b = TK.align_completion(F.lit("Human: x y "), F.lit("Assistant: z"))
    assert _one(spark, b["tokens_aligned"]) is False


def test_pandas_tokenizer_hook_feeds_native_masking(spark):
    vocab = {}

    def encode(texts):
        return [[vocab.setdefault(w, len(vocab) + 1) for w in t.split()] for t in texts]

    tok = TK.pandas_tokenizer(encode)
    df = spark.createDataFrame([("a b", "a b c d")], "prompt string, full string")
    staged = df.select(tok("prompt").alias("p"), tok("full").alias("ids"))
    ids, mask = TK.pad_right(F.col("ids"), 6, pad_id=0)
    out = staged.select(ids.alias("ids"), mask.alias("mask"), F.col("p")).select(
        "ids", "mask", TK.common_prefix_len(F.col("p"), F.col("ids")).alias("plen")
    )
    r = out.select(TK.loss_labels(F.col("ids"), F.col("mask"), F.col("plen")).alias("labels"), "plen").first()
    assert r.plen == 2
    assert list(r.labels)[:2] == [-100, -100] and list(r.labels)[4:] == [-100, -100]


def test_loss_mask_keeps_long_texts_whole_and_counts_what_a_length_drops(spark, scratch):
    from pairforge.plans.q_tokens import loss_mask
    from tests.conftest import SF_SMALL

    turns = [(1, 0, "user", "q " * 1500), (1, 1, "assistant", "a " * 600), (2, 0, "user", "q"), (2, 1, "assistant", "a")]
    like = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema if f.name not in rows.columns]
    rows.select(*[F.col(c).cast(like.schema[c].dataType).alias(c) for c in rows.columns], *missing).write.parquet(f"{scratch}/conversations.parquet")
    whole = {r.example_id: r for r in loss_mask(spark, scratch).collect()}
    assert whole[0].n_tokens > 2100 and whole[0].prompt_len > 1500 and whole[0].n_label_tokens > 600
    cut = {r.example_id: r for r in loss_mask(spark, scratch, 1024).collect()}
    assert cut[0].n_tokens == 1024 and cut[0].n_label_tokens == 0 and cut[0].n_dropped == whole[0].n_tokens - 1024
    assert cut[1].n_dropped == 0 and cut[1][:6] == whole[1][:6]
