"""Model hooks (R1-R3, F3): Arrow batches, per-row error isolation, long output + regroup."""

import pytest
from pyspark.sql import functions as F

from pairforge.operators.infer import ExpressionModel, PandasModel, generate_long
from pairforge.operators.regroup import regroup_ordered


def flaky_factory():
    def generate(prompts, n):
        if any("boom" in p for p in prompts):
            raise RuntimeError("device error")
        return [[f"{p}-{j}" for j in range(n)] for p in prompts]

    return generate


def oom_factory():
    def generate(prompts, n):
        raise MemoryError("out of memory")

    return generate


def test_error_isolation_marks_only_bad_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "boom"), (3, "c")], "id long, p string")
    out = PandasModel("flaky", flaky_factory, batch_size=8).apply(df, "p", "o").orderBy("id").collect()
    assert [r.o for r in out] == ["a-0", None, "c-0"]
    assert out[1].o_error.startswith("RuntimeError") and out[0].o_error is None


def test_out_of_memory_fails_the_job(spark):
    df = spark.createDataFrame([(1, "a")], "id long, p string")
    with pytest.raises(Exception, match="out of memory"):
        PandasModel("oom", oom_factory).apply(df, "p", "o").collect()


def test_long_samples_regroup_in_sample_order(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, p string")
    long = generate_long(df.repartition(2), PandasModel("ok", flaky_factory), "id", "p", 3)
    g = regroup_ordered(long, "id", "sample_index", "text", "responses").orderBy("id").collect()
    assert [list(r.responses) for r in g] == [["x-0", "x-1", "x-2"], ["y-0", "y-1", "y-2"]]


def test_expression_model(spark):
    df = spark.createDataFrame([(1, "x")], "id long, p string")
    m = ExpressionModel("upper", lambda c: F.upper(c))
    assert m.apply(df, "p", "o").first().o == "X"


class OutOfMemoryError(RuntimeError):
    """Named like the accelerator library's error, which subclasses RuntimeError."""


def device_oom_factory():
    def generate(prompts, n):
        raise OutOfMemoryError("device out of memory")

    return generate


def test_device_out_of_memory_is_not_isolated(spark):
    df = spark.createDataFrame([(1, "a")], "id long, p string")
    with pytest.raises(Exception, match="device out of memory"):
        PandasModel("device-oom", device_oom_factory).apply(df, "p", "o").collect()


def test_halving_finds_bad_rows_in_few_calls():
    from pairforge.operators.infer import _call_isolated

    made = []

    def generate(prompts, n):
        made.append(len(prompts))
        if any("bad" in p for p in prompts):
            raise RuntimeError("no")
        return [[p] * n for p in prompts]

    prompts = [f"p{i}" for i in range(64)]
    prompts[37] = "bad"
    texts, errors, calls = _call_isolated(generate, prompts, 1)
    assert [i for i, e in enumerate(errors) if e] == [37] and errors[37] == "RuntimeError: no" and texts[37] is None
    assert [t[0] for i, t in enumerate(texts) if i != 37] == [p for p in prompts if p != "bad"]
    assert len(made) == 13 and calls[37] == 7 and calls[0] == 2  # 1 + 2 log2(64) calls rather than 65
    made.clear()
    assert _call_isolated(generate, ["bad"] * 8, 2)[1] == ["RuntimeError: no"] * 8 and len(made) == 15
    assert _call_isolated(generate, [], 1) == ([], [], [])


def test_calls_are_counted_per_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, "boom"), (3, "c"), (4, "d")], "id long, p string").coalesce(1)
    out = PandasModel("flaky-counted", flaky_factory, batch_size=4, count_calls=True).apply(df, "p", "o").orderBy("id").collect()
    assert [(r.o, r.o_calls) for r in out] == [("a-0", 3), (None, 3), ("c-0", 2), ("d-0", 2)]
