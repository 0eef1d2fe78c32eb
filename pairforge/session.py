"""Session helpers.

On a cluster the session is created by the platform and ``spark.checkpoint.dir`` names a
shared folder; we only read it.  Tests and local runs get a fresh scratch folder when the
setting is absent.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, app_name: str = "pairforge", shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session with the settings the operators assume (AQE on, UTC, no UI)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    Order: the context's active checkpoint dir, then ``spark.checkpoint.dir`` from the
    session or context configuration, and only when both are unset (local tests) a fresh
    scratch folder.
    """
    sc = spark.sparkContext
    active = sc._jsc.sc().getCheckpointDir()
    if active.isDefined():
        return active.get()
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="pairforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` once as a Parquet table in the shared checkpoint folder
    and reading it back.

    Unlike ``Dataset.checkpoint()`` (which, unless persisted, computes its input twice:
    once to count, once to write) the plan runs once; the stored table is columnar and
    compressed, and later reads prune columns and push filters.  A lost executor re-reads
    the files instead of recomputing anything upstream.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables) -> None:
    """Delete the files of tables that ``materialize`` wrote, once nothing will read them again: a round's
    table when the next round's is written.  Other DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path is not None:
            jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
            df._stored_at = None


def stage_key(spark, *paths: str) -> tuple:
    """Memo key for a stage table derived from ``paths`` within one session: the JVM
    session's UUID plus each source's path, length and modification time."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sig = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        st = hp.getFileSystem(conf).getFileStatus(hp)
        sig.append((p, st.getLen(), st.getModificationTime()))
    return (spark._jsparkSession.sessionUUID(), tuple(sig))
