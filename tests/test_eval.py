"""Rank metrics (N2/N3), summary on empty input (A5), zero-filled counts (A3)."""

from pyspark.sql import functions as F

from pairforge.operators import evaluate as EV
from pairforge.schemas import EVAL_RESULT


def test_rank_metrics_fixture(spark):
    # labels {1: sft, 2: dpo, 3: pretrained}, ranking [2, 1, 3]
    df = spark.createDataFrame([([2, 1, 3], ["sft", "dpo", "pretrained"])], "ranking array<int>, order array<string>")
    m = EV.rank_metrics(F.col("ranking"), F.col("order"))
    r = df.select(*[c.alias(k) for k, c in m.items()]).first()
    assert r.dpo_beats_sft is True and r.sft_beats_pretrained is True
    assert r.best_model == "dpo" and list(r.ranking_models) == ["dpo", "sft", "pretrained"]


def test_summary_on_no_rows(spark):
    empty = spark.createDataFrame([], EVAL_RESULT)
    s = EV.eval_summary(empty, "p", "s", "j").first()
    assert s.num_examples == 0 and s.dpo_beats_sft == 0 and s.dpo_beats_sft_rate == 0.0
    assert s.sft_beats_pretrained_rate == 0.0
    assert dict(s.best_model_counts) == {"pretrained": 0, "sft": 0, "dpo": 0}
    counts = {r.best_model: r.n for r in EV.best_model_counts(empty).collect()}
    assert counts == {"pretrained": 0, "sft": 0, "dpo": 0}


def test_best_counts_keep_unknown_and_missing(spark):
    df = spark.createDataFrame([("dpo",), ("other",), (None,)], "best_model string")
    counts = {r.best_model: r.n for r in EV.best_model_counts(df).collect()}
    assert counts == {"pretrained": 0, "sft": 0, "dpo": 1, "other": 1, "": 1}


def test_heldout_top_up(spark):
    from pairforge.sources import tables as TB
    from tests.conftest import SF_MID

    ex = TB.examples(spark, SF_MID)
    used = TB.prior_generation_prompts(ex)
    remaining = EV.heldout_examples(ex, used).count()  # held-out rows left after exclusion
    n = remaining - 1
    plain = EV.heldout_examples(ex, used, num_examples=n)
    topped = EV.heldout_examples(ex, used, num_examples=n, top_up=True)
    assert plain.count() < n and topped.count() == n  # Q3: no top-up by default
    assert {r.eval_id for r in plain.collect()} <= {r.eval_id for r in topped.collect()}


def test_summary_counts_unknown_and_missing(spark):
    row = lambda best, wins: (best, wins, wins)
    df = spark.createDataFrame([row("dpo", True), row("other", False), row(None, None)], "best_model string, dpo_beats_sft boolean, sft_beats_pretrained boolean")
    s = EV.eval_summary(df, "p", "s", "j").first()
    assert (s.num_examples, s.dpo_beats_sft, s.sft_beats_pretrained) == (3, 1, 1)
    assert dict(s.best_model_counts) == {"pretrained": 0, "sft": 0, "dpo": 1, "other": 1, "": 1}


def test_incomplete_examples_are_not_ranked(spark):
    from pairforge.functions import stub_models as S
    from pairforge.operators.infer import PandasModel

    def broken():
        def generate(prompts, num_samples):
            if any("bad" in p for p in prompts):
                raise RuntimeError("no answer")
            return [["a much longer answer"] * num_samples for _ in prompts]
        return generate

    rows = [(i, "bad" if i == 2 else "good", "", "bad" if i == 2 else "good", "ref") for i in range(4)]
    held = spark.createDataFrame(rows, "eval_id long, instruction string, input string, prompt string, reference_output string")
    models = {**S.stub_systems(), "dpo": PandasModel("stub/broken", broken)}
    results, failed = EV.blind_eval(held, models, S.stub_rank_judge())
    lost = {r.eval_id: r.detail for r in failed.collect()}
    assert lost[2] == "no response of: dpo"
    assert 2 not in {r.eval_id for r in results.collect()}


def test_evaluation_reaches_every_example(spark):
    import __spark_entry__ as E
    from pairforge.sources import tables as TB
    from tests.conftest import SF_SMALL

    ids = sorted(r.example_id for r in TB.examples(spark, SF_SMALL).select("example_id").collect())
    run = lambda name: E.queries()[name](spark, SF_SMALL)
    for name in ("assemble_systems", "blind_labels", "blind_prompt", "parse_ranking"):
        assert sorted(r.eval_id for r in run(name).select("eval_id").collect()) == ids
    parsed = run("parse_ranking").filter("ranking IS NOT NULL").count()
    assert run("rank_metrics").count() == run("blind_eval").count() == run("eval_summary").first().num_examples == parsed > 0
    assert sum(r.n for r in run("best_model_counts").collect()) == parsed
