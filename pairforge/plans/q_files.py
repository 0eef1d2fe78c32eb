"""Registered queries over landed files: versioned output (K1, K2, K4), bad lines (S1), artifact folders (S5, F8,
N4), publish then delete (X4), arrivals with state (X2) and isolated model failures (F3, R3).

Stand-in artifacts: each ``supplier`` row is a checkpoint folder of the run named after its nation, with a config
(empty for a negative balance), weights and trainer state.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge import oracle as O
from pairforge.operators import artifacts as A
from pairforge.operators.infer import PandasModel
from pairforge.plans.catalog import REGISTRY, _teacher_pairs_df, register
from pairforge.schemas import INSTRUCTION, PREFERENCE
from pairforge.session import materialize
from pairforge.sources import io
from pairforge.sources import tables as TB
from pairforge.sources.files import list_tree, write_files
from pairforge.sources.versioned import read_version, versions, write_version
from pairforge.streaming import arrivals as AR
from pairforge.streaming import streams as X


@register(
    "publish_versions",
    f"SELECT *, CAST(2 AS BIGINT) AS version FROM ({REGISTRY['pairs_teacher'].sql})",
    "K1/K2/K4 pairs appended in two chunks through the committing sink, the second one twice; read back as of the last version",
)
def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = materialize(_teacher_pairs_df(spark, sf_dir).select(*PREFERENCE.names), "pairs")
    out = X.run_folder(spark, "versions")
    half = TB.responses(spark, sf_dir).count() // 2
    write_version(pairs.filter(F.col("example_id") < half), out, chunk="first")
    rest = pairs.filter(F.col("example_id") >= half)
    for _ in range(2):  # a run that does not know whether its last append went through repeats it
        write_version(rest, out, chunk="second")
    return read_version(spark, out, PREFERENCE).withColumn("version", F.lit(versions(out)[-1]).cast("bigint"))


_BAD = "'{\"example_id\": ' || CAST(example_id AS VARCHAR) || ', \"instruction\": '"


@register(
    "bad_lines",
    O.with_ctes(
        O.EXAMPLES_CTE,
        f"SELECT {_BAD} AS raw FROM examples WHERE example_id % 7 = 3 UNION ALL SELECT '{{\"example_id\": \"x' || CAST(example_id AS VARCHAR) || '\"}}' FROM examples WHERE example_id % 11 = 5",
    ),
    "S1 report of the landed JSONL lines that the declared schema rejects: cut off, and of a wrong type",
)
def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = TB.examples(spark, sf_dir)
    number = F.col("example_id").cast("string")
    lines = F.array(
        F.to_json(F.struct("example_id", "instruction", "input", "output")), F.lit("  "),
        F.when(F.col("example_id") % 7 == 3, F.concat(F.lit('{"example_id": '), number, F.lit(', "instruction": '))),
        F.when(F.col("example_id") % 11 == 5, F.concat(F.lit('{"example_id": "x'), number, F.lit('"}'))),
    )
    folder = os.path.join(X.run_folder(spark, "landed"), "examples")
    ex.select(F.explode(F.array_compact(lines)).alias("value")).write.text(folder)
    return io.bad_lines(spark, folder, INSTRUCTION).select("raw")


def _planted():
    def generate(prompts: list[str], num_samples: int) -> list[list[str]]:
        if any(hashlib.md5(p.encode()).hexdigest()[0] == "0" for p in prompts):
            raise RuntimeError("planted")
        return [[p.upper()] * num_samples for p in prompts]

    return generate


@register(
    "isolated_failures",
    O.with_ctes(
        O.RESPONSES_CTE,
        "SELECT example_id, md5(prompt)[1] = '0' AS failed, CASE WHEN md5(prompt)[1] = '0' THEN 'RuntimeError: planted' END AS error FROM responses",
    ),
    "F3/R3 text-in text-out model over all responses, in batches; failing batches are halved until only the failing rows are left",
)
def isolated_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = TB.responses(spark, sf_dir).select("example_id", "prompt")
    out = PandasModel("planted-failures", _planted, batch_size=64, count_calls=True).apply(rows, "prompt", "text")
    return out.select("example_id", F.col("text").isNull().alias("failed"), F.col("text_error").alias("error"))


def _land(spark: SparkSession, sf_dir: str, root: str, with_run: bool) -> DataFrame:
    """Write the stand-in artifacts under ``root``; returns what was written."""
    s = TB.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    folder = F.concat(F.lit(root + "/"), *([F.lit("run-"), F.col("s_nationkey").cast("string"), F.lit("/")] if with_run else []), F.lit("checkpoint-"), F.col("s_suppkey").cast("string"))
    config = F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit('{"r": '), F.col("s_nationkey").cast("string"), F.lit("}")))
    made = ((C.ADAPTER_CONFIG, config), (C.ADAPTER_WEIGHTS, F.col("s_name")), (C.EXPORT_EXCLUDE[0], F.lit("state")))
    files = s.select(F.explode(F.array(*[F.struct(F.concat_ws("/", folder, F.lit(n)).alias("path"), c.cast("binary").alias("content")) for n, c in made])).alias("f"))
    return materialize(write_files(files.select("f.*")), "landed-files")


@register(
    "resolve_artifacts",
    """WITH c AS (SELECT 'run-' || s_nationkey AS run, s_suppkey AS version, coalesce(s_acctbal, 0) >= 0 AS valid, length(s_name) + length('{"r": ' || s_nationkey || '}') AS b FROM supplier)
SELECT run, count(*) AS n_checkpoints, count(*) FILTER (WHERE valid) AS n_valid,
       'checkpoint-' || max(version) FILTER (WHERE valid) AS latest, max(version) FILTER (WHERE valid) AS latest_version,
       CASE WHEN bool_or(valid) THEN 2 ELSE 0 END AS n_files, coalesce(arg_max(b, version) FILTER (WHERE valid), 0) AS n_bytes
FROM c GROUP BY run""",
    "S5/F8/N4 artifact folders on real files: list, open only configs, latest valid checkpoint per run, size of its export",
)
def resolve_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = os.path.join(X.run_folder(spark, "artifacts"), "runs")
    _land(spark, sf_dir, root, with_run=True)
    return A.resolve_runs(A.scan_runs(spark, root))


@register(
    "publish_groups",
    f"""WITH g AS (SELECT 'checkpoint-' || s_suppkey AS group_key, coalesce(s_acctbal, 0) >= 0 AS ready, s_name, s_nationkey FROM supplier),
f AS (SELECT group_key, ready, unnest([{{'n': {O.q(C.ADAPTER_CONFIG)}, 'l': CASE WHEN ready THEN length('{{"r": ' || s_nationkey || '}}') ELSE 0 END}},
        {{'n': {O.q(C.ADAPTER_WEIGHTS)}, 'l': length(s_name)}}, {{'n': {O.q(C.EXPORT_EXCLUDE[0])}, 'l': 5}}]) AS x FROM g)
SELECT group_key, x.n AS file, CAST(x.l AS BIGINT) AS length, ready AS published, NOT ready AS in_landing, ready AND x.n <> {O.q(C.EXPORT_EXCLUDE[0])} AS exported FROM f""",
    "X4 two-phase publish over micro-batches: copy ready groups, commit their manifest, delete their sources on a later batch",
)
def publish_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per landed file: whether its group was published, whether the file still lies in the landing folder, and
    whether the published folder holds it.  All three are read from the folders after the stream has ended."""
    folder = X.run_folder(spark, "publish")
    landing, out = os.path.join(folder, "landing"), os.path.join(folder, "out")
    landed = _land(spark, sf_dir, landing, with_run=False)
    scan = A.scan_runs(spark, landing)
    valid = scan.filter(F.col("file") == C.ADAPTER_CONFIG).filter("valid").select(F.col("dir").alias("group_key"))
    weights = scan.filter((F.col("file") == C.ADAPTER_WEIGHTS) & (F.col("length") > 0)).select(F.col("dir").alias("group_key"))
    ready = os.path.join(folder, "ready")
    valid.join(weights, "group_key", "left_semi").repartition(3, "group_key").write.json(ready)
    publisher = AR.GroupPublisher(spark, landing, out, exclude=C.EXPORT_EXCLUDE)
    stream = X.file_stream(spark, ready, "group_key string", "json", max_files_per_trigger=1)
    query = stream.writeStream.foreachBatch(publisher).option("checkpointLocation", os.path.join(folder, "_checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    publisher.sweep()

    def held(root: str, flag: str) -> DataFrame:
        files, parts = materialize(list_tree(spark, root), flag), F.split("path", "/")
        return files.select(F.element_at(parts, -2).alias("group_key"), F.element_at(parts, -1).alias("file"), F.lit(True).alias(flag))

    parts = F.split("path", "/")
    every = landed.select(F.element_at(parts, -2).alias("group_key"), F.element_at(parts, -1).alias("file"), "length")
    published = publisher.manifest().filter("deleted").select("group_key", F.element_at(parts, -1).alias("file"), F.lit(True).alias("published"))
    for more in (published, held(landing, "in_landing"), held(os.path.join(out, "files"), "exported")):
        every = every.join(more, ["group_key", "file"], "left")
    return every.fillna(False, ["published", "in_landing", "exported"])


GAP_HOURS, DELAY_HOURS = 6, 1


@register(
    "stream_complete_groups",
    f"""WITH RECURSIVE e AS (SELECT user_id, ts, event_type, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL {GAP_HOURS} HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e),
g AS (SELECT user_id, sid, min(ts) AS f, max(ts) AS l, count(*) AS n, bool_or(event_type = 'signup') AS a, bool_or(event_type = 'purchase') AS b FROM s GROUP BY user_id, sid),
c AS (SELECT * FROM g WHERE l + INTERVAL {GAP_HOURS} HOUR <= (SELECT max(ts) FROM events) - INTERVAL {DELAY_HOURS} HOUR),
r AS (SELECT user_id, sid, f, l, n, a, b FROM c WHERE sid = 1
      UNION ALL
      SELECT c.user_id, c.sid, CASE WHEN r.a AND r.b THEN c.f ELSE r.f END, c.l, CASE WHEN r.a AND r.b THEN c.n ELSE r.n + c.n END,
             (r.a AND NOT r.b) OR c.a, (r.b AND NOT r.a) OR c.b
      FROM r JOIN c ON c.user_id = r.user_id AND c.sid = r.sid + 1)
SELECT CAST(user_id AS VARCHAR) AS group_key, f AS first_file, l AS last_change, n AS n_files FROM r WHERE a AND b""",
    "X2 on arrival, with state and timers: a group is emitted once both files are there and nothing came for the gap",
)
def stream_complete_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = X.run_folder(spark, "complete")
    events = TB.table(spark, sf_dir, "events")
    path = os.path.join(sf_dir, "events.parquet")
    whole = io.is_folder(spark, path)
    stream = X.file_stream(spark, path if whole else sf_dir, events.schema, "parquet", glob=None if whole else "events.parquet")
    out = os.path.join(folder, "groups")
    with AR.with_rocksdb(spark):
        groups = AR.complete_groups(stream.select("user_id", "ts", "event_type"), "user_id", "ts", "event_type", ("signup", "purchase"), GAP_HOURS * 3600, f"{DELAY_HOURS} hours")
        X.run_append(groups, out, os.path.join(folder, "_checkpoint"), state_partitions=spark.sparkContext.defaultParallelism)
    got = spark.read.schema(AR.OUTPUT).parquet(out)
    return got.select("group_key", F.col("first_file").cast("timestamp_ntz").alias("first_file"), F.col("last_change").cast("timestamp_ntz").alias("last_change"), "n_files")
