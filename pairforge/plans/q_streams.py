"""Registered streaming queries (X1-X5).  Each runs a Structured Streaming job to completion
with ``availableNow`` and returns its committed output as a batch DataFrame, so the result can
be checked against the same oracle as the batch form."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pairforge import constants as C
from pairforge.functions import stub_models as S
from pairforge.operators import joins as J
from pairforge.operators import pairs as P
from pairforge.plans.catalog import REGISTRY, _teacher_pairs_df, register
from pairforge.schemas import GENERATED
from pairforge.sources import tables as TB
from pairforge.sources.io import is_folder
from pairforge.streaming import streams as X
from pairforge.session import materialize

_GENERATED_WITH_REF = T.StructType(GENERATED.fields + [T.StructField("reference_output", T.StringType())])


def _response_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Land the generated rows as JSONL files (K1), one a partition, the way the generation stage leaves them."""
    folder = X.run_folder(spark, name)
    src = os.path.join(folder, "responses")
    TB.responses(spark, sf_dir, keep_reference=True).write.json(src)
    return folder


@register(
    "stream_pairs",
    REGISTRY["pairs_teacher"].sql,
    "X1/X3 teacher pairs as a streaming transformation over a polled folder of generated rows (exactly-once file sink)",
)
def stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair plan is narrow, so it runs directly on the stream: Spark plans it once and
    executes it per micro-batch.  (A non-deterministic judge would instead use
    ``streams.run_batches`` so each batch's verdicts are written once before branching.)"""
    folder = _response_files(spark, sf_dir, "pairs")
    stream = X.file_stream(spark, os.path.join(folder, "responses"), _GENERATED_WITH_REF, "json", max_files_per_trigger=spark.sparkContext.defaultParallelism)
    pairs = P.build_pairs(stream, S.stub_judge(C.MODE_TEACHER), C.MODE_TEACHER, S.stub_teacher(reference="reference_output"))
    out = os.path.join(folder, "pairs")
    X.run_append(pairs, out, os.path.join(folder, "_checkpoint"))
    return spark.read.parquet(out)


@register(
    "stream_resume",
    REGISTRY["resume_pending"].sql,
    "X5/X3 stream-static resume anti-join: streamed candidates minus ids already in the pair output",
)
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _response_files(spark, sf_dir, "resume")
    done = materialize(_teacher_pairs_df(spark, sf_dir).select("example_id"), "done_ids")
    stream = X.file_stream(spark, os.path.join(folder, "responses"), _GENERATED_WITH_REF, "json", max_files_per_trigger=spark.sparkContext.defaultParallelism)
    pending = J.resume_pending(stream, done).select("example_id", "prompt")
    out = os.path.join(folder, "pending")
    X.run_append(pending, out, os.path.join(folder, "_checkpoint"))
    return spark.read.parquet(out)


GAP_HOURS, DELAY_HOURS = 6, 1


@register(
    "stream_quiet_groups",
    f"""WITH e AS (SELECT user_id, ts, event_type, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL {GAP_HOURS} HOUR THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e),
g AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {GAP_HOURS} HOUR AS session_end, count(*) AS n_files,
             bool_or(event_type = 'signup') AS has_config, bool_or(event_type = 'purchase') AS has_weights
      FROM s GROUP BY user_id, sid)
SELECT * FROM g WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL {DELAY_HOURS} HOUR""",
    "X2 quiet-period groups as session windows with a watermark over a polled folder (append mode)",
)
def stream_quiet_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = X.run_folder(spark, "quiet")
    events = TB.table(spark, sf_dir, "events")
    path = os.path.join(sf_dir, "events.parquet")
    if is_folder(spark, path):
        stream = X.file_stream(spark, path, events.schema, "parquet")
    else:
        stream = X.file_stream(spark, sf_dir, events.schema, "parquet", glob="events.parquet")
    sessions = X.quiet_sessions(
        stream.select("user_id", "ts", "event_type"), "user_id", "ts", "event_type", ("signup", "purchase"),
        f"{GAP_HOURS} hours", f"{DELAY_HOURS} hours",
    )
    out = os.path.join(folder, "sessions")
    X.run_append(sessions, out, os.path.join(folder, "_checkpoint"), state_partitions=spark.sparkContext.defaultParallelism)
    return spark.read.parquet(out)
