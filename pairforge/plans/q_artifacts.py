"""Registered queries over ``events`` read as an artifact log.

Mapping (both engines): ``user_id`` is the run folder, ``event_id`` the checkpoint number,
``ts`` the file time, ``props`` the config text; an ``error`` event left an empty config.
For quiet-period readiness a folder is ``(user_id, day)``; ``signup`` events stand for the
adapter config file and ``purchase`` events for the weights file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import oracle as O
from pairforge.operators import artifacts as A
from pairforge.plans.catalog import register
from pairforge.sources import tables as TB

CONFIG_KIND, WEIGHTS_KIND = "signup", "purchase"


def _candidates(spark, sf_dir) -> DataFrame:
    ev = TB.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "props")
    content = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("props"))
    return ev.select(
        "user_id",
        F.concat(F.lit("checkpoint-"), F.col("event_id").cast("string")).alias("name"),
        A.checkpoint_version(F.concat(F.lit("checkpoint-"), F.col("event_id").cast("string"))).alias("version"),
        A.config_is_valid(F.length(content), content).alias("valid"),
    )


@register(
    "latest_valid",
    """WITH c AS (
  SELECT user_id, 'checkpoint-' || CAST(event_id AS VARCHAR) AS name, event_id AS version,
         CASE WHEN event_type = 'error' THEN false ELSE length(props) > 0 AND coalesce(json_valid(props), false) END AS valid
  FROM events)
SELECT user_id, count(*) AS n_checkpoints, count(*) FILTER (WHERE valid) AS n_valid,
       arg_max(name, version) FILTER (WHERE valid) AS latest, max(version) FILTER (WHERE valid) AS latest_version
FROM c GROUP BY user_id""",
    "N4/F7/L7 per run folder, the highest-numbered checkpoint whose config is non-empty valid JSON",
)
def latest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.latest_valid(_candidates(spark, sf_dir), ["user_id"], "name", "version", "valid")


@register(
    "config_validity",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN false ELSE length(props) > 0 AND coalesce(json_valid(props), false) END AS valid
FROM events""",
    "F7 config validity per artifact: non-empty and exactly one JSON document",
)
def config_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = TB.table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    content = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("props"))
    return ev.select("event_id", A.config_is_valid(F.length(content), content).alias("valid"))


@register(
    "quiet_groups",
    f"""SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_files, max(ts) AS last_change,
       count(*) FILTER (WHERE event_type = {O.q(CONFIG_KIND)}) > 0 AS has_config,
       count(*) FILTER (WHERE event_type = {O.q(WEIGHTS_KIND)}) > 0 AS has_weights,
       (max(ts) <= (SELECT max(ts) FROM events) - INTERVAL 120 SECOND
        AND count(*) FILTER (WHERE event_type = {O.q(CONFIG_KIND)}) > 0
        AND count(*) FILTER (WHERE event_type = {O.q(WEIGHTS_KIND)}) > 0) AS ready
FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "X2 batch quiet-period readiness: no change for 120 s before the scan and both required files present",
)
def quiet_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = TB.table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    asof = ev.select(F.max("ts")).scalar()
    files = ev.withColumn("day", F.to_date("ts"))
    return A.quiet_groups(files, ["user_id", "day"], "ts", "event_type", (CONFIG_KIND, WEIGHTS_KIND), asof)


@register(
    "benchmark_overlap",
    """SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON strpos(d.text, b.text) > 0""",
    "D2b text-overlap audit: documents that contain a benchmark passage verbatim (anchor n-gram index + exact check)",
)
def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.operators.joins import text_containment

    docs = TB.table(spark, sf_dir, "documents").select("doc_id", "text")
    items = TB.table(spark, sf_dir, "benchmark").select("item_id", "text")
    return text_containment(docs, items)


@register(
    "benchmark_overlap_short",
    """WITH w AS (SELECT string_split(text, ' ') AS w FROM benchmark),
p AS (SELECT DISTINCT unnest([w[5], w[5] || ' ' || w[6]]) AS passage FROM w)
SELECT p.passage, count(*) AS n_docs, min(d.doc_id) AS first_doc FROM documents d JOIN p ON strpos(d.text, p.passage) > 0
WHERE trim(p.passage) <> '' GROUP BY p.passage""",
    "D2b text-overlap audit for passages of one and two words (letter-gram index over the vocabulary + exact check)",
)
def benchmark_overlap_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairforge.operators.joins import text_containment

    docs = TB.table(spark, sf_dir, "documents").select("doc_id", "text")
    w = F.split("text", " ")
    one, two = F.get(w, F.lit(4)), F.get(w, F.lit(5))
    passages = TB.table(spark, sf_dir, "benchmark").select(F.explode(F.array(one, F.concat(one, F.lit(" "), two))).alias("passage"))
    passages = passages.filter(F.trim("passage") != "").distinct().withColumn("text", F.col("passage"))
    found = text_containment(docs, passages, item_key="passage")
    return found.groupBy("passage").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
