"""End-to-end runs E1-E4 on sf0.001 with stub models: resume, chunked outputs, summaries."""

import os

from pairforge import constants as C
from pairforge.functions import stub_models as S
from pairforge.operators.infer import PandasModel
from pairforge.plans import runs
from pairforge.sources import tables as TB
from tests.conftest import SF_SMALL


def test_generate_judge_train_eval(spark, scratch):
    ex = TB.examples(spark, SF_SMALL)
    n = ex.count()
    gen_out = os.path.join(scratch, "gen")
    model = PandasModel("stub/echo-sampler", S.echo_sampler_factory)
    first = runs.generation_run(spark, ex, model, gen_out, max_examples=10, chunk_id=0)
    assert first.count() == 10
    second = runs.generation_run(spark, ex, model, gen_out, chunk_id=1)  # resume: only the rest
    assert second.count() == n - 10
    generated = spark.read.schema(first.schema).json(gen_out)
    assert generated.select("example_id").distinct().count() == n

    pref_out = os.path.join(scratch, "prefs")
    teacher = S.stub_teacher(reference="instruction")
    pairs, counters = runs.judging_run(
        spark, generated, S.stub_judge(C.MODE_TEACHER), pref_out, teacher=teacher,
        dead_letter_path=os.path.join(scratch, "dead"), chunk_id=0,
    )
    assert counters["pending"] == n and counters["kept"] + counters["skipped"] == n
    assert pairs.count() == counters["kept"]
    again, c2 = runs.judging_run(spark, generated, S.stub_judge(C.MODE_TEACHER), pref_out, teacher=teacher, chunk_id=1)
    assert c2["pending"] == counters["skipped"] and again.count() == 0  # failed verdicts retried, still failing

    train, ev = runs.training_set_run(spark, pairs, os.path.join(scratch, "train"))
    assert train.count() + ev.count() == pairs.count() and ev.count() >= 1
    assert train.columns == ["prompt", "chosen", "rejected"]


def test_evaluation_run_summary(spark, scratch):
    ex = TB.examples(spark, SF_SMALL)
    out, summ = os.path.join(scratch, "eval"), os.path.join(scratch, "summary")
    s = runs.evaluation_run(spark, ex, S.stub_systems(), S.stub_rank_judge(), out, summ, num_examples=None, chunk_id=0).first()
    assert s.num_examples == sum(s.best_model_counts.values())
    again = runs.evaluation_run(spark, ex, S.stub_systems(), S.stub_rank_judge(), out, summ, num_examples=None, chunk_id=1).first()
    assert again.num_examples == s.num_examples  # resume: nothing new, summary over the whole file


def test_summary_run_filter(spark, scratch):
    from pairforge.operators.infer import ExpressionModel

    ex = TB.examples(spark, SF_SMALL)
    out, summ = os.path.join(scratch, "eval"), os.path.join(scratch, "summary")
    first = runs.evaluation_run(spark, ex, S.stub_systems(), S.stub_rank_judge(), out, summ, num_examples=None, chunk_id=0).first()
    other = S.stub_rank_judge()
    other_judge = ExpressionModel("stub/other-ranker", other.fn, prepare=other.prepare, cleanup=other.cleanup)
    both = runs.evaluation_run(spark, ex, S.stub_systems(), other_judge, out, summ, num_examples=None, resume=False, chunk_id=1).first()
    mine = runs.evaluation_run(spark, ex, S.stub_systems(), other_judge, out, summ, num_examples=None, chunk_id=2,
                               only_this_judge=True).first()
    assert both.num_examples == 2 * first.num_examples  # Q4: every row in the output counts
    assert mine.num_examples == first.num_examples


def test_group_wise_split_keeps_prompts_together(spark, scratch):
    from pyspark.sql import functions as F

    rows = spark.range(0, 400).select(
        F.col("id").alias("example_id"), F.concat(F.lit("p"), (F.col("id") % 50).cast("string")).alias("prompt"),
        F.lit("Assistant: a").alias("chosen"), F.lit("Assistant: b").alias("rejected"),
    )
    train, ev = runs.training_set_run(spark, rows, os.path.join(scratch, "g"), eval_split=0.2, group_key="prompt")
    t = {r.prompt for r in train.select("prompt").collect()}
    e = {r.prompt for r in ev.select("prompt").collect()}
    assert t and e and not (t & e) and train.count() + ev.count() == 400
