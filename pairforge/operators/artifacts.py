"""Artifact manifests: validity (F7), latest valid checkpoint (N4, L7), quiet-period
readiness (X2 batch form), export filtering (F8) and folder listing (S5).

A manifest has one row per file: ``dir, file, length, mtime, content``.  Everything is a
``groupBy`` with partial aggregation (``max_by``, ``count_if``), so one directory with a
third of all files is pre-aggregated map-side rather than sent whole to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge.functions.text import strip_ws
from pairforge.functions.verdict import is_valid_json
from pairforge.session import materialize
from pairforge.sources.files import list_tree, read_files

_INT_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*$"


def config_is_valid(length: Column, content: Column) -> Column:
    """a non-empty file whose whole content is one JSON document."""
    return (length > 0) & F.coalesce(is_valid_json(content), F.lit(False))


def checkpoint_version(name: Column) -> Column:
    """``int(name.rsplit("-", 1)[-1])``; names without an integer suffix give NULL (Q27)."""
    suffix = strip_ws(F.substring_index(name, "-", -1))
    return F.when(suffix.rlike(_INT_TEXT), F.regexp_replace(suffix, "_", "").try_cast("bigint"))


def latest_valid(candidates: DataFrame, group: list[str], name: str, version: str, valid: str) -> DataFrame:
    """Per group, the highest-version candidate whose config is valid (NULL if none)."""
    return candidates.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_checkpoints"),
        F.count_if(F.col(valid)).alias("n_valid"),
        F.max_by(F.when(F.col(valid), F.col(name)), F.when(F.col(valid), F.col(version))).alias("latest"),
        F.max(F.when(F.col(valid), F.col(version))).alias("latest_version"),
    )


def quiet_groups(
    files: DataFrame, group: list[str], mtime: str, kind: str, required: tuple[str, str], asof: Column, quiet_seconds: int = C.QUIET_PERIOD_SEC
) -> DataFrame:
    """X2 (batch): a group is ready when nothing changed for ``quiet_seconds`` before ``asof``
    and both required kinds are present (seconds, not whole minutes: Q17)."""
    a, b = required
    g = files.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.max(mtime).alias("last_change"),
        (F.count_if(F.col(kind) == a) > 0).alias("has_config"),
        (F.count_if(F.col(kind) == b) > 0).alias("has_weights"),
    )
    quiet = F.col("last_change") <= asof - F.make_dt_interval(secs=F.lit(quiet_seconds))
    return g.withColumn("ready", quiet & F.col("has_config") & F.col("has_weights"))


def exportable(manifest: DataFrame, file_col: str = "file") -> DataFrame:
    """F8: drop trainer-state files from an export."""
    return manifest.filter(~F.col(file_col).isin(*C.EXPORT_EXCLUDE))


def scan_runs(spark: SparkSession, root: str) -> DataFrame:
    """S5 over a folder of runs (``root/<run>/<checkpoint>/<file>``): ``run, dir, file, length, mtime, valid``.

    Tasks list the folders, once, and open only the config files, which are joined to their row by folder; no file
    name passes through the driver.  ``valid`` is null for other files, and false for configs in folders that Spark's
    readers hide (``.name``, ``_name`` without ``=``).
    """
    parts = F.split(F.col("path"), "/")
    listed = materialize(list_tree(spark, root), "run-files")
    named = listed.select(
        "path", F.element_at(parts, -3).alias("run"), F.element_at(parts, -2).alias("dir"), F.element_at(parts, -1).alias("file"), "length", "mtime"
    )
    below = F.substr("path", F.lit(len(root.rstrip("/")) + 1))
    configs = named.filter((F.col("file") == C.ADAPTER_CONFIG) & ~below.rlike(r"/(\.|_[^/=]*/)"))
    checked = read_files(configs.repartition(spark.sparkContext.defaultParallelism, "path")).select(
        F.element_at(parts, -3).alias("run"), F.element_at(parts, -2).alias("dir"), F.lit(C.ADAPTER_CONFIG).alias("file"),
        config_is_valid(F.col("length"), F.col("content").cast("string")).alias("readable"),
    )
    checked, listed = materialize(checked, "configs"), named.drop("path")
    valid = F.when(F.col("file") == C.ADAPTER_CONFIG, F.coalesce("readable", F.lit(False)))
    return listed.join(checked, ["run", "dir", "file"], "left").withColumn("valid", valid).drop("readable")


def resolve_runs(manifest: DataFrame) -> DataFrame:
    """N4 + L7 + F8 per run of ``scan_runs``: checkpoint folders, those with a valid config, the latest of these and
    what its export holds (files and bytes without the trainer's own)."""
    own = manifest.groupBy("run", "dir").agg(F.max(F.coalesce("valid", F.lit(False))).alias("valid"))
    own = own.withColumn("version", checkpoint_version(F.col("dir")))
    latest = latest_valid(own, ["run"], "dir", "version", "valid")
    export = exportable(manifest).groupBy("run", F.col("dir").alias("latest")).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    return latest.join(export, ["run", "latest"], "left").fillna(0, ["n_files", "n_bytes"])


def list_artifacts(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Manifest ``dir, file, length, mtime, content`` of every file under ``root``."""
    raw = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    parts = F.split(F.col("path"), "/")
    return raw.select(
        F.element_at(parts, -2).alias("dir"),
        F.element_at(parts, -1).alias("file"),
        F.col("length"),
        F.col("modificationTime").alias("mtime"),
        F.col("content").cast("string").alias("content"),
    )


def resolve_adapter_dir(spark: SparkSession, root: str) -> str:
    """N4 for one folder: the root itself when its config is valid, else the highest
    ``checkpoint-N`` with a valid config; raises when there is none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        return root

    def checked(pattern: str) -> DataFrame | None:
        """The config files that match, one level deep at most, with their folder's name and validity."""
        found = [s.getPath().toString() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, pattern)) or []]
        if not found:
            return None
        raw = spark.read.format("binaryFile").load(found)
        name = F.element_at(F.split("path", "/"), -2)
        return raw.select(name.alias("dir"), config_is_valid(F.col("length"), F.col("content").cast("string")).alias("valid"))

    own = checked(C.ADAPTER_CONFIG)
    if own is not None and own.first()["valid"]:
        return root
    below = checked(f"checkpoint-*/{C.ADAPTER_CONFIG}")
    if below is not None:
        cands = below.withColumn("version", checkpoint_version(F.col("dir"))).withColumn("g", F.lit(1))
        best = latest_valid(cands, ["g"], "dir", "version", "valid").select("latest").first()["latest"]
        if best is not None:
            return f"{root.rstrip('/')}/{best}"
    raise ValueError(f"No valid {C.ADAPTER_CONFIG} under {root}")
