"""Structured Streaming forms of the polling and resume loops.

* X1  a file-source ``readStream`` polled on a processing-time trigger (tests use
      ``availableNow``);
* X2  quiet-period completeness as ``session_window`` + watermark in append mode: a group is
      emitted once nothing arrived for the gap and the watermark has passed its end;
* X3  exactly-once resume: the checkpoint records committed offsets, and ``foreachBatch``
      writes each micro-batch to a ``batch_id``-keyed folder with overwrite, so a replayed
      batch replaces its own output;
* X4  ``cleanSource`` deletes or archives files of committed batches;
* X5  stream-static anti-join for the resume/leakage filter.

Checkpoints and outputs live under ``spark.checkpoint.dir`` (the shared folder), never in a
machine-local temporary directory.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.session import ensure_checkpoint_dir


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", max_files_per_trigger: int | None = None,
    clean_source: str | None = None, archive_dir: str | None = None, glob: str | None = None,
) -> DataFrame:
    """Poll a folder for new files; optionally delete/archive files once committed."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(path)


def run_batches(
    stream: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    out_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    fmt: str = "parquet",
    wait: bool = True,
):
    """Apply a batch plan to every micro-batch, writing ``out/batch_id=<n>`` idempotently."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        process(batch).write.mode("overwrite").format(fmt).save(os.path.join(out_path, f"batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    query = writer.start()
    if wait:
        query.awaitTermination()
    return query


def poll(
    stream: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    out_path: str,
    checkpoint: str,
    interval: str = "300 seconds",
):
    """X1 in production: scan for new files every ``interval`` and process them as one
    micro-batch; returns the running query (stop it with ``query.stop()``)."""
    return run_batches(stream, process, out_path, checkpoint, trigger={"processingTime": interval}, wait=False)


def quiet_sessions(
    events: DataFrame, key: str, ts: str, kind: str, required: tuple[str, str], gap: str, delay: str
) -> DataFrame:
    """X2 (stream): per ``key``, sessions that went quiet for ``gap``; emitted in append mode
    once the watermark (max event time − ``delay``) passes the session end.  Late rows beyond
    the delay are dropped by the watermark, by design."""
    a, b = required
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", delay)
    g = timed.groupBy(F.col(key), F.session_window("__ts", gap).alias("session")).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.max(F.when(F.col(kind) == a, F.lit(1)).otherwise(F.lit(0))).alias("__a"),
        F.max(F.when(F.col(kind) == b, F.lit(1)).otherwise(F.lit(0))).alias("__b"),
    )
    return g.select(
        key,
        F.col("session.start").cast("timestamp_ntz").alias("session_start"),
        F.col("session.end").cast("timestamp_ntz").alias("session_end"),
        "n_files",
        (F.col("__a") == 1).alias("has_config"),
        (F.col("__b") == 1).alias("has_weights"),
    )


def run_append(
    stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None,
    state_partitions: int | None = None,
):
    """Append-mode file sink (exactly-once via the sink's commit log).

    ``state_partitions`` sizes the state store of a new stateful query (it is fixed in the
    checkpoint at first start); the session setting is restored right after the start.
    """
    spark = stream.sparkSession
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        q = writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    q.awaitTermination()
    return q


def dedupe(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Drop re-delivered rows with the same ``key`` seen within ``delay`` of event time
    (state is bounded by the watermark, unlike an unbounded ``dropDuplicates``)."""
    timed = stream.withColumn("__dedupe_ts", F.col(ts).cast("timestamp")).withWatermark("__dedupe_ts", delay)
    return timed.dropDuplicatesWithinWatermark([key]).drop("__dedupe_ts")
