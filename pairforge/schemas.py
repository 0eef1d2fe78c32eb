"""Declared row schemas (M1-M12).  Never infer: inference turns maps into structs and
reorders ragged columns (SURVEY §1)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


INSTRUCTION = _st(("example_id", L), ("instruction", S), ("input", S), ("output", S))

GEN_CONFIG = _st(
    ("model_id", S), ("num_samples", I), ("max_new_tokens", I), ("temperature", D), ("top_p", D),
    ("no_repeat_ngram_size", I), ("repetition_penalty", D), ("seed", L),
)

GENERATED = _st(
    ("example_id", L), ("instruction", S), ("input", S), ("prompt", S), ("responses", T.ArrayType(S)), ("gen_config", GEN_CONFIG)
)

PREFERENCE = _st(
    ("example_id", L), ("instruction", S), ("input", S), ("prompt", S), ("judge_model", S), ("judge_prompt_version", S),
    ("preference_mode", S), ("chosen", S), ("rejected", S), ("judge_reason", S), ("rejected_sft_index", I),
    ("best_index", I), ("worst_index", I), ("chosen_source", S), ("rejected_source", S),
)

TRAINING_PAIR = _st(("prompt", S), ("chosen", S), ("rejected", S))

EVAL_EXAMPLE = _st(("eval_id", L), ("instruction", S), ("input", S), ("prompt", S))

EVAL_RESULT = _st(
    ("eval_id", L), ("instruction", S), ("input", S), ("prompt", S), ("responses", T.MapType(S, S)),
    ("ranking", T.ArrayType(I)), ("label_to_model", T.MapType(S, S)), ("judge_reason", S), ("judge_model", S),
    ("blind_ranking", B), ("dpo_beats_sft", B), ("sft_beats_pretrained", B), ("best_model", S),
    ("ranking_models", T.ArrayType(S)),
)

EVAL_SUMMARY = _st(
    ("num_examples", L), ("dpo_beats_sft", L), ("dpo_beats_sft_rate", D), ("sft_beats_pretrained", L),
    ("sft_beats_pretrained_rate", D), ("best_model_counts", T.MapType(S, L)), ("dpo_model_path", S),
    ("sft_model_id", S), ("judge_model_id", S),
)

TOKENISED = _st(("input_ids", T.ArrayType(I)), ("attention_mask", T.ArrayType(I)), ("labels", T.ArrayType(I)))

CHAT = T.ArrayType(_st(("role", S), ("content", S)))

MANIFEST = _st(("dir", S), ("file", S), ("length", L), ("mtime", T.TimestampType()), ("content", S))


def id_only(key: str) -> T.StructType:
    """The id column of a finished output (S4 reads nothing else)."""
    return _st((key, L))
