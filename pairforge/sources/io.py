"""Sources and sinks: JSONL and table scans (S1-S4), chunked appends, summary and publish
writes (K1-K4).

Durability: the reference appends and flushes one JSON line per row.  Here the unit of
durability is a chunk (a micro-batch, or one ``append_chunk`` call): each chunk is written to
its own ``chunk=<id>`` folder with overwrite semantics, so a retried chunk replaces rather
than duplicates its rows, and a resume reads the ids of every committed chunk.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.operators.joins import resume_pending


def read_rows(
    spark: SparkSession,
    schema: T.StructType,
    path: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """Exactly one of ``path`` (JSONL) or ``table``.

    JSONL is read with the declared schema in FAILFAST mode: a malformed line fails the
    job as the reference's unguarded ``json.loads`` does.  Blank lines are skipped.
    """
    if path and table:
        raise ValueError("Provide only one of path or table")
    if not path and not table:
        raise ValueError("Provide path or table")
    if path:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.table(table)


def bad_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S1 report beside FAILFAST: the lines that the declared schema rejects, as ``file, line, raw``.

    ``line`` counts from 1 within the file, blank lines included, as an editor shows it.  A file is read in
    blocks by as many tasks as it has: a line's number is its place in its block plus the lines of the blocks
    before, so only one count a block is shuffled.
    """
    corrupt = "__corrupt"
    declared = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"),
    )
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", F.coalesce(before, F.lit(0)))
    parsed = F.from_json("raw", declared, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    bad = lines.filter((F.trim("raw") != "") & parsed[corrupt].isNotNull())
    return bad.join(blocks, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "raw")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def is_folder(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hpath).isDirectory()


def completed_ids(spark: SparkSession, path: str, key: str = "example_id", fmt: str = "json") -> DataFrame:
    """Ids already written to ``path``; an absent output means nothing is done.

    Only the id column is read (column pruning / a one-field JSON schema).
    """
    schema = T.StructType([T.StructField(key, T.LongType())])
    if not _exists(spark, path):
        return spark.range(0).select(F.lit(None).cast("long").alias(key))
    reader = spark.read.schema(schema)
    df = reader.json(path) if fmt == "json" else reader.format(fmt).load(path)
    return df.select(key).filter(F.col(key).isNotNull())


def append_chunk(df: DataFrame, path: str, chunk_id: int | str, fmt: str = "json") -> str:
    """K1/K2: write one chunk under ``path/chunk=<id>`` and return its folder.

    A chunk that was committed (its ``_SUCCESS`` exists) is never overwritten: a run that reuses
    the id, such as a resumed one, adds a chunk with a suffix of its own.  What an attempt left
    uncommitted is replaced.
    """
    target = os.path.join(path, f"chunk={chunk_id}")
    if _exists(df.sparkSession, os.path.join(target, "_SUCCESS")):
        target += f"-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").format(fmt).save(target)
    return target


def append_pending(
    spark: SparkSession, df: DataFrame, path: str, chunk_id: int | str, key: str = "example_id", fmt: str = "json"
) -> DataFrame:
    """Resume-safe append: drop rows whose ``key`` is already written, then append a chunk.

    Returns the rows that were written (still lazy; they were computed once by the write).
    """
    pending = resume_pending(df, completed_ids(spark, path, key, fmt), key)
    append_chunk(pending, path, chunk_id, fmt)
    return pending


def write_summary(df: DataFrame, path: str) -> None:
    """K3: overwrite a one-row summary as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def publish(spark: SparkSession, source: str, schema: T.StructType, target: str | None, fmt: str = "parquet") -> DataFrame:
    """K4: re-read the *whole* output (every chunk, not only this run's rows) and export it."""
    if not target:
        raise ValueError("a publish target is required")
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(source).drop("chunk")
    rows.write.mode("overwrite").format(fmt).save(target)
    return spark.read.format(fmt).load(target)
