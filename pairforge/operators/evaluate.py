"""Blind N-way evaluation (L6, P9, R7, R8, N2, N3) and its summary (A1-A5).

Plan:  held-out examples (split → seeded shuffle → ids → prompt → leakage exclusion)
       → one generation stage per system, long rows ``(eval_id, system, text)``
       → D3 assemble by id → per-row seeded label permutation → blind prompt → judge hook
       → strict ranking parse → metrics → summary (a global aggregate, one row even on
       empty input).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge.functions import text as T
from pairforge.functions import verdict as V
from pairforge.functions.mersenne import shuffle_labels
from pairforge.operators.infer import TextModel
from pairforge.operators.joins import assemble_systems, exclude_by_text
from pairforge.operators.sampling import shuffle_positions, shuffle_take, split_exact
from pairforge.operators.stages import close_stage
from pairforge.session import materialize


def heldout_examples(
    examples: DataFrame,
    used_prompts: DataFrame | None = None,
    num_examples: int | None = None,
    split_seed: int = C.SPLIT_SEED,
    shuffle_seed: int = C.DEFAULT_SEED,
    fraction: float = C.SPLIT_FRACTION,
    keep_reference: bool = False,
    top_up: bool = False,
) -> DataFrame:
    """``eval_id, instruction, input, prompt`` for the held-out split.

    ``keep_reference`` carries the example's ``output`` as ``reference_output`` (used by the
    deterministic system stubs).

    ``eval_id`` is the shuffled position, assigned *before* leakage exclusion (ids have gaps,
    and fewer than ``num_examples`` may remain: Q3).  ``top_up`` excludes first and then
    keeps the first ``num_examples`` positions that remain (a bounded top-N).
    """
    cols = ["example_id", "instruction", "input"] + (["output"] if keep_reference else [])
    test = split_exact(examples.select(*cols), "example_id", fraction, split_seed)
    test = test.filter(F.col("split") == "test").drop("split")
    if num_examples is not None and not top_up:
        shuffled = shuffle_take(test, "example_id", num_examples, shuffle_seed, pos_col="eval_id")
    else:
        shuffled = shuffle_positions(test, "example_id", shuffle_seed, pos_col="eval_id")
    if top_up and num_examples is not None:
        rows = shuffled.select(
            "eval_id", "instruction", T.or_empty("input").alias("input"), T.format_prompt("instruction", "input").alias("prompt"),
            *([F.col("output").alias("reference_output")] if keep_reference else []),
        )
        return exclude_by_text(rows, used_prompts, "prompt").orderBy("eval_id").limit(num_examples)
    rows = shuffled.select(
        "eval_id", "instruction", T.or_empty("input").alias("input"), T.format_prompt("instruction", "input").alias("prompt"),
        *([F.col("output").alias("reference_output")] if keep_reference else []),
    )
    return exclude_by_text(rows, used_prompts, "prompt")


def all_examples(examples: DataFrame) -> DataFrame:
    """Every example in the shape of ``heldout_examples`` (with references): its dense id is the ``eval_id``."""
    return examples.select(
        F.col("example_id").alias("eval_id"), "instruction", T.or_empty("input").alias("input"),
        T.format_prompt("instruction", "input").alias("prompt"), F.col("output").alias("reference_output"),
    )


def system_outputs(
    heldout: DataFrame, models: dict[str, TextModel], key: str = "eval_id", carry: Sequence[str] = ()
) -> DataFrame:
    """R2: one generation stage per system; long rows ``(key, system, text, *carry)`` (P4 applied).

    A row whose hook failed keeps a null text, so that its example is known to be incomplete.
    """
    parts = []
    for system, model in models.items():
        gen = model.apply(heldout, "prompt", "__out")
        text = F.when(F.col("__out_error").isNull(), T.ensure_assistant_prefix("__out"))
        parts.append(gen.select(key, F.lit(system).alias("system"), text.alias("text"), *carry))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def blind_labels(key: Column, systems: Sequence[str] = C.SYSTEMS, seed: int = C.DEFAULT_SEED) -> Column:
    """Systems in label order 1..n, permuted per row by ``md5(seed + key, system)``.

    Like the reference, the row's stream is seeded with the *sum* ``seed + key``.  The
    permutation is uniform and independent of row order, partitioning and resume.  It is not the
    Mersenne-Twister shuffle bit for bit; ``blind_labels_exact`` is.
    """
    row_seed = (F.lit(seed) + key).cast("string")
    tagged = F.array(
        *[F.struct(F.md5(F.concat(F.lit("blind:"), row_seed, F.lit(":" + s))).alias("h"), F.lit(s).alias("s")) for s in systems]
    )
    return F.transform(F.array_sort(tagged), lambda x: x["s"])


def blind_labels_exact(key: Column, systems: Sequence[str] = C.SYSTEMS, seed: int = C.DEFAULT_SEED) -> Column:
    """L6, bit for bit: ``random.Random(seed + key).shuffle`` of ``systems``, vectorised over Arrow batches."""
    return shuffle_labels(F.lit(seed) + key, systems)


def label_map(order: Column) -> Column:
    """J4p: ``{"1": system, "2": system, ...}`` with string keys, as written to JSON."""
    return F.map_from_arrays(F.transform(order, lambda _x, i: (i + 1).cast("string")), order)


def blind_prompts(
    assembled: DataFrame, systems: Sequence[str] = C.SYSTEMS, seed: int = C.DEFAULT_SEED, key: str = "eval_id", exact: bool = False
) -> DataFrame:
    """L6 + P9: label order, label map and the blind prompt for each assembled row.

    ``exact`` takes the reference's own generator (Arrow) instead of the native md5 order.
    """
    order = (blind_labels_exact if exact else blind_labels)(F.col(key), systems, seed)
    with_order = assembled.withColumn("label_order", order)
    labelled = F.transform(F.col("label_order"), lambda s: F.col("responses")[s])
    return with_order.withColumns(
        {
            "label_to_model": label_map(F.col("label_order")),
            "labelled_responses": labelled,
            "blind_prompt": T.blind_rank_prompt("instruction", "input", labelled),
        }
    )


def rank_metrics(ranking: Column, label_order: Column) -> dict[str, Column]:
    """Positions per system, pairwise beat flags, best system, ordered systems."""
    def model_of(label: Column) -> Column:
        return F.get(label_order, label - 1)

    def pos_of(system: str) -> Column:
        label = F.array_position(label_order, F.lit(system))
        return F.array_position(ranking, label.cast("int")) - 1

    return {
        "dpo_beats_sft": pos_of("dpo") < pos_of("sft"),
        "sft_beats_pretrained": pos_of("sft") < pos_of("pretrained"),
        "best_model": model_of(F.get(ranking, 0)),
        "ranking_models": F.transform(ranking, model_of),
    }


def assemble_outputs(heldout: DataFrame, models: dict[str, TextModel]) -> DataFrame:
    """R2 → D3: the responses of every example, null where a system failed.

    One shuffle: the per-system rows carry the example's columns, so assembly needs no join.
    """
    carry = [c for c in heldout.columns if c != "eval_id"]
    assembled = assemble_systems(system_outputs(heldout, models, carry=carry), "eval_id", carry=carry)
    return assembled if all(m.deterministic for m in models.values()) else materialize(assembled, "assembled")


def _missing(models: Sequence[str]) -> Column:
    """The systems without a response."""
    return F.filter(F.array(*[F.lit(s) for s in models]), lambda s: F.col("responses")[s].isNull())


def prepare_blind(heldout: DataFrame, models: dict[str, TextModel], seed: int = C.DEFAULT_SEED, exact: bool = False) -> DataFrame:
    """R2 → D3 → L6 → P9: label order/map and the blind prompt of the examples that all systems answered."""
    complete = assemble_outputs(heldout, models).filter(F.size(_missing(tuple(models))) == 0)
    return blind_prompts(complete, tuple(models), seed, exact=exact)


def judge_blind(prompted: DataFrame, judge: TextModel, num_systems: int) -> DataFrame:
    """Judge hook → strict ranking parse (J3p/F6), as a closed stage."""
    judged = judge.apply(prompted, "blind_prompt", "judge_raw")
    judged = V.with_ranking(judged, "judge_raw", num_systems, "parsed")
    if not judge.deterministic:
        judged = materialize(judged, "blind_judged")
    return close_stage(
        judged, "blind_judge", {"judged": F.count(F.lit(1)), "parsed": F.count_if(F.col("parsed").isNotNull())}
    )


def blind_results(judged: DataFrame, judge_name: str) -> DataFrame:
    """N2/N3 metrics over parsed rows, in the M6 result shape."""
    ok = judged.filter(F.col("parsed").isNotNull() & F.col("judge_raw_error").isNull())
    metrics = rank_metrics(F.col("parsed.ranking"), F.col("label_order"))
    return ok.select(
        "eval_id", "instruction", "input", "prompt", "responses",
        F.col("parsed.ranking").alias("ranking"),
        "label_to_model",
        F.col("parsed.reason").alias("judge_reason"),
        F.lit(judge_name).alias("judge_model"),
        F.lit(True).alias("blind_ranking"),
        *[c.alias(n) for n, c in metrics.items()],
    )


def blind_eval(
    heldout: DataFrame,
    models: dict[str, TextModel],
    judge: TextModel,
    seed: int = C.DEFAULT_SEED,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(results in the M6 shape, rows that a system did not answer or whose ranking failed to parse)."""
    missing = _missing(tuple(models))
    assembled = assemble_outputs(heldout, models)
    incomplete = assembled.filter(F.size(missing) > 0).select(
        "eval_id", F.concat(F.lit("no response of: "), F.array_join(missing, ", ")).alias("detail")
    )
    judged = judge_blind(blind_prompts(assembled.filter(F.size(missing) == 0), tuple(models), seed, exact=exact), judge, len(models))
    failed = judged.filter(F.col("parsed").isNull() | F.col("judge_raw_error").isNotNull()).select(
        "eval_id", F.coalesce("judge_raw_error", "judge_raw").alias("detail")
    )
    return blind_results(judged, judge.name), failed.unionByName(incomplete)


def eval_summary(results: DataFrame, dpo_model_path: str, sft_model_id: str, judge_model_id: str) -> DataFrame:
    """A1/A2/A5: one summary row (also on empty input); best counts as in ``best_model_counts`` (A3)."""
    one = lambda flag: F.coalesce(F.col(flag), F.lit(False)).cast("long").alias(flag)
    zero = F.lit(0).cast("long")
    seen = results.select(F.coalesce("best_model", F.lit("")).alias("best_model"), F.lit(1).cast("long").alias("n"), one("dpo_beats_sft"), one("sft_beats_pretrained"))
    known = results.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in C.SYSTEMS])).alias("best_model"), *[zero.alias(c) for c in ("n", "dpo_beats_sft", "sft_beats_pretrained")]
    )
    per_best = seen.unionByName(known).groupBy("best_model").agg(*[F.sum(c).alias(c) for c in ("n", "dpo_beats_sft", "sft_beats_pretrained")])
    agg = per_best.agg(
        F.sum("n").alias("num_examples"),
        F.sum("dpo_beats_sft").alias("dpo_beats_sft"),
        F.sum("sft_beats_pretrained").alias("sft_beats_pretrained"),
        F.map_from_entries(F.collect_list(F.struct("best_model", "n"))).alias("best_model_counts"),
    )
    rate = lambda wins: F.when(F.col("num_examples") > 0, F.col(wins) / F.col("num_examples")).otherwise(F.lit(0.0))
    return agg.select(
        "num_examples",
        "dpo_beats_sft",
        rate("dpo_beats_sft").alias("dpo_beats_sft_rate"),
        "sft_beats_pretrained",
        rate("sft_beats_pretrained").alias("sft_beats_pretrained_rate"),
        "best_model_counts",
        F.lit(dpo_model_path).alias("dpo_model_path"),
        F.lit(sft_model_id).alias("sft_model_id"),
        F.lit(judge_model_id).alias("judge_model_id"),
    )


def best_model_counts(results: DataFrame, systems: Sequence[str] = C.SYSTEMS) -> DataFrame:
    """A3: counts per best system, zero-filled for known systems; unknown kept, missing under ''.

    The known systems enter as zero rows of a UNION ALL, then one partial aggregation sums
    them with the observed rows: no join, and a dominant system is pre-aggregated map-side.
    """
    spark = results.sparkSession
    zeros = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in systems])).alias("best_model"), F.lit(0).cast("long").alias("n"))
    seen = results.select(F.coalesce(F.col("best_model"), F.lit("")).alias("best_model"), F.lit(1).cast("long").alias("n"))
    return seen.unionByName(zeros).groupBy("best_model").agg(F.sum("n").alias("n"))
