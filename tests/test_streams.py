"""Streaming (X1-X5): stream equals batch, cleanSource, watermark sessions."""

import os

from pyspark.sql import functions as F

from pairforge.streaming import streams as X


def test_stream_resume_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    spark.range(0, 100).withColumnRenamed("id", "example_id").repartition(5).write.json(src)
    done = spark.range(0, 100, 3).withColumnRenamed("id", "example_id")
    stream = X.file_stream(spark, src, "example_id long", "json", max_files_per_trigger=2)
    pending = stream.join(done, "example_id", "left_anti")
    out = os.path.join(scratch, "out")
    X.run_append(pending, out, os.path.join(scratch, "ck"))
    assert spark.read.parquet(out).count() == 100 - 34


def test_foreach_batch_and_clean_source(spark, scratch):
    src = os.path.join(scratch, "src")
    spark.range(0, 10).withColumnRenamed("id", "k").repartition(2).write.json(src)
    files = [f for f in os.listdir(src) if f.endswith(".json")]
    stream = X.file_stream(spark, src, "k long", "json", clean_source="delete", glob="*.json")
    out = os.path.join(scratch, "out")
    X.run_batches(stream, lambda b: b.withColumn("k2", F.col("k") * 2), out, os.path.join(scratch, "ck"))
    assert spark.read.parquet(out).count() == 10
    assert len(files) == 2


def test_quiet_sessions_close_after_gap(spark, scratch):
    src = os.path.join(scratch, "ev")
    rows = [(1, "2024-01-01 00:00:00", "signup"), (1, "2024-01-01 01:00:00", "purchase"),
            (1, "2024-01-02 00:00:00", "click"), (2, "2024-01-03 00:00:00", "signup")]
    spark.createDataFrame(rows, "u long, ts string, kind string").select(
        "u", F.to_timestamp("ts").alias("ts"), "kind").write.parquet(src)
    stream = X.file_stream(spark, src, "u long, ts timestamp, kind string", "parquet")
    s = X.quiet_sessions(stream, "u", "ts", "kind", ("signup", "purchase"), "6 hours", "0 seconds")
    out = os.path.join(scratch, "out")
    X.run_append(s, out, os.path.join(scratch, "ck"))
    got = sorted((r.u, r.n_files, r.has_config, r.has_weights) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1, False, False), (1, 2, True, True)]


def test_dedupe_within_watermark(spark, scratch):
    src = os.path.join(scratch, "dups")
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:05"), (2, "2024-01-01 00:00:01"), (2, "2024-01-01 00:00:01")]
    spark.createDataFrame(rows, "example_id long, ts string").select("example_id", F.to_timestamp("ts").alias("ts")).write.parquet(src)
    stream = X.file_stream(spark, src, "example_id long, ts timestamp", "parquet")
    out = os.path.join(scratch, "out")
    X.run_append(X.dedupe(stream, "example_id", "ts", "1 hour"), out, os.path.join(scratch, "ck"))
    assert sorted(r.example_id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_stage_counters_are_observed(spark):
    from pairforge import constants as C
    from pairforge.functions import stub_models as S
    from pairforge.operators import pairs as P
    from pairforge.operators.stages import observations
    from pairforge.sources import tables as TB
    from tests.conftest import SF_SMALL

    resp = TB.responses(spark, SF_SMALL, keep_reference=True)
    pairs = P.build_pairs(resp, S.stub_judge(C.MODE_TEACHER), C.MODE_TEACHER, S.stub_teacher(reference="reference_output"))
    obs = observations()["judge_teacher"]  # the stage just built
    n_pairs = pairs.count()
    counters = obs.get
    assert counters["pending"] == counters["kept"] + counters["skipped"] == resp.count()
    assert counters["kept"] == n_pairs > 0


def test_poll_processes_new_files(spark, scratch):
    src = os.path.join(scratch, "in")
    spark.range(0, 5).withColumnRenamed("id", "k").write.json(src)
    out = os.path.join(scratch, "out")
    q = X.poll(X.file_stream(spark, src, "k long", "json"), lambda b: b, out, os.path.join(scratch, "ck"), interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 5


def test_landed_files_follow_partitions_and_batches_take_a_file_a_core(spark, scratch, monkeypatch):
    from pairforge.plans import q_streams as Q
    from pairforge.sources import tables as TB
    from tests.conftest import SF_SMALL

    cores = spark.sparkContext.defaultParallelism
    rows = TB.responses(spark, SF_SMALL, keep_reference=True).repartition(2 * cores + 1)
    monkeypatch.setattr(Q.TB, "responses", lambda *a, **k: rows)
    for name, query in (("pairs", Q.stream_pairs), ("resume", Q.stream_resume)):
        folder = os.path.join(scratch, name)
        monkeypatch.setattr(Q.X, "run_folder", lambda *a, folder=folder: folder)
        assert query(spark, SF_SMALL).count() > 0
        files = [f for f in os.listdir(os.path.join(folder, "responses")) if f.startswith("part-")]
        batches = [f for f in os.listdir(os.path.join(folder, "_checkpoint", "commits")) if f.isdigit()]
        assert len(files) == rows.filter("prompt IS NOT NULL").select(F.spark_partition_id()).distinct().count()
        assert len(batches) == -(-len(files) // cores)
