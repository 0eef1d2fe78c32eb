"""Resuming from a written output (S4, D1, K1): bucketed ids, no exchange over them, crash between rows and ids."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.sources.done import ResumableOutput

SCHEMA = T.StructType([T.StructField("example_id", T.LongType()), T.StructField("text", T.StringType())])


def _rows(spark, ids):
    return spark.createDataFrame([(i, f"t{i}") for i in ids], SCHEMA)


def test_runs_resume_and_chunks_stay(spark, scratch):
    out = ResumableOutput(spark, scratch + "/out", SCHEMA, buckets=4)
    assert out.done().count() == 0 and out.rows().count() == 0
    assert out.pending(_rows(spark, range(3))).count() == 3
    assert out.commit(out.pending(_rows(spark, range(5))), "a").count() == 5
    out.commit(_rows(spark, range(90, 99)), "a")  # committed already: not written again
    again = ResumableOutput(spark, scratch + "/out", SCHEMA, buckets=99)  # another session's view of the same files
    assert again.buckets == 4
    again.commit(again.pending(_rows(spark, [*range(8), 8, 8])), "b")
    assert sorted((r.example_id, r.chunk) for r in out.rows().collect()) == [(i, "a") for i in range(5)] + [(5, "b"), (6, "b"), (7, "b"), (8, "b"), (8, "b")]
    assert sorted(r[0] for r in out.done().select("example_id").collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 8]
    assert out.pending(_rows(spark, range(12))).count() == 3


def test_null_ids_are_never_done(spark, scratch):
    out = ResumableOutput(spark, scratch + "/out", SCHEMA, buckets=2)
    out.commit(_rows(spark, [None, 1]), "a")
    assert sorted(r[0] is None for r in out.pending(_rows(spark, [None, 1, 2])).collect()) == [False, True]
    assert out.done().count() == 1 and out.rows().count() == 2


def test_ids_lost_between_rows_and_ids_are_recovered(spark, scratch, monkeypatch):
    out = ResumableOutput(spark, scratch + "/out", SCHEMA, buckets=2)
    monkeypatch.setattr(ResumableOutput, "_add_ids", lambda self, chunk: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        out.commit(_rows(spark, range(4)), "a")
    monkeypatch.undo()
    assert out.done().count() == 0 and out.rows().count() == 4
    assert out.recover("a") and not out.recover("a") and not out.recover("zzz")
    assert out.pending(_rows(spark, range(6))).count() == 2


def test_resume_plan_has_no_exchange_over_the_done_side(spark, scratch):
    out = ResumableOutput(spark, scratch + "/out", SCHEMA, buckets=8)
    for k in range(3):
        out.commit(_rows(spark, range(100 * k, 100 * k + 100)), str(k))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pending = out.pending(_rows(spark, range(400)))
        plan = pending._jdf.queryExecution().executedPlan().toString()
        assert pending.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange") < plan.index("Bucketed: true")  # the candidates' side only
    assert "Exchange" not in plan[plan.index("LeftAnti") :].split("Exchange", 1)[1]


def test_done_files_hold_one_sorted_bucket_each_and_bloom_filters(spark, scratch):
    import pyarrow.parquet as pq

    out = ResumableOutput(spark, scratch + "/out", SCHEMA, buckets=4)
    out.commit(_rows(spark, range(2000)), "a")
    files = [f for f in os.listdir(scratch + "/out/done") if f.endswith(".parquet")]
    assert len(files) == 4
    for f in files:
        ids = pq.read_table(f"{scratch}/out/done/{f}").column("example_id").to_pylist()
        assert ids == sorted(ids)
    raw = open(f"{scratch}/out/done/{files[0]}", "rb").read()
    plain = len(pq.read_table(f"{scratch}/out/done/{files[0]}"))
    assert len(raw) > plain  # a filter of its ids comes with the file
    with pytest.raises(ValueError):
        ResumableOutput(spark, scratch + "/odd", T.StructType([T.StructField("example_id", T.DoubleType())]))
    assert out.done().filter(F.col("example_id") == 5).count() == 1
