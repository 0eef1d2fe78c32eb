"""X2 and X4 with state: groups that are complete and then quiet, published once, deleted only after that.

``complete_groups`` (X2) keeps per group what has arrived and a timer, with ``transformWithState``.  Session windows
cannot say "both files are there, and since then nothing came": a config that arrives an hour before the weights is
another session.  Here kinds gathered in earlier bursts stay with the group until it has been emitted.

``GroupPublisher`` (X4) is the two-phase form of "delete after a successful upload".  Each micro-batch first finishes
what earlier batches published (phase two: delete the source files of every group in a committed manifest), then
publishes its own groups and commits their manifest (phase one).  A failure at any point leaves either the source
files or a committed manifest that names them, so nothing is lost and nothing unpublished is deleted.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pairforge.session import materialize
from pairforge.sources.files import copy_files, delete_files, list_files
from pairforge.sources.io import _exists

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: A group's open runs, a column each, what the closed ones left, and when its timer fires: one value a group, since
#: each call for state is a round trip to the JVM.
RUNS = "starts array<bigint>, lasts array<bigint>, ns array<bigint>, with_a array<boolean>, with_b array<boolean>"
STATE = f"{RUNS}, start bigint, n bigint, a boolean, b boolean, wake bigint"
OUTPUT = "group_key string, first_file timestamp, last_change timestamp, n_files bigint"


def merged_runs(runs: list[tuple], gap: int) -> list[tuple]:
    """(start, last, n, a, b) runs in time order, those less than ``gap`` apart joined."""
    out: list[tuple] = []
    for start, last, n, a, b in sorted(runs):
        if out and start - out[-1][1] < gap:
            p = out[-1]
            out[-1] = (p[0], max(p[1], last), p[2] + n, p[3] or a, p[4] or b)
        else:
            out.append((start, last, n, a, b))
    return out


def bursts(us: np.ndarray, a: np.ndarray, b: np.ndarray, gap: int) -> list[tuple]:
    """The runs of one frame of arrivals in any order."""
    if not len(us):
        return []
    order = np.argsort(us, kind="stable")
    us, a, b = us[order], a[order].astype(bool), b[order].astype(bool)
    first = np.flatnonzero(np.concatenate([[True], np.diff(us) >= gap]))
    end = np.append(first[1:], len(us))
    columns = us[first], us[end - 1], end - first, np.logical_or.reduceat(a, first), np.logical_or.reduceat(b, first)
    return list(zip(*(c.tolist() for c in columns), strict=True))


class QuietGroups(StatefulProcessor):
    """Per group: runs of arrivals at least a gap apart, of which the closed ones (a gap older than the
    watermark) are folded into what the group holds.  When a closed run leaves both kinds there, the group
    is emitted and starts anew.  State a group: a handful of numbers and the runs within the watermark's delay."""

    def __init__(self, gap_us: int):
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("group", STATE)

    def _load(self) -> tuple[list[tuple], tuple, int | None]:
        """The open runs, what the closed ones left (start, n, a, b), and the time of the timer."""
        got = self.state.get()
        if got is None:
            return [], (None, 0, False, False), None
        runs, held, wake = tuple(got[:5]), tuple(got[5:9]), got[9]
        return list(zip(*runs, strict=True)), held, wake

    def _store(self, runs: list[tuple], held: tuple, wake: int | None) -> None:
        """Store both in one value, and wake when the first run closes."""
        at = -(-(runs[0][1] + self.gap) // 1000) if runs else None
        if at != wake:
            if wake is not None:
                self.handle.deleteTimer(wake)
            if at is not None:
                self.handle.registerTimer(at)
        if runs or held[0] is not None:
            self.state.update((*([list(c) for c in zip(*runs, strict=True)] if runs else [[]] * 5), *held, at))
        else:
            self.state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        runs, held, wake = self._load()
        for frame in rows:  # frames of bounded size: a large group is reduced to its runs bit by bit
            runs = merged_runs(runs + bursts(*(frame[c].to_numpy() for c in ("us", "a", "b")), self.gap), self.gap)
        self._store(runs, held, wake)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, ready = timerValues.getCurrentWatermarkInMs(), []
        runs, (start, n, a, b), wake = self._load()
        closed = 0
        while closed < len(runs) and runs[closed][1] + self.gap <= 1000 * watermark:
            first, last, more, has_a, has_b = runs[closed]
            closed += 1
            start, n, a, b = first if start is None else start, n + more, a or has_a, b or has_b
            if a and b:
                ready.append((key[0], start, last, n))
                start, n, a, b = None, 0, False, False
        self._store(runs[closed:], (start, n, a, b), wake)
        if not ready:
            return iter(())
        frame = pd.DataFrame(ready, columns=["group_key", "first_file", "last_change", "n_files"])
        for c in ("first_file", "last_change"):
            frame[c] = frame[c].to_numpy().astype("datetime64[us]")
        return iter([frame])

    def close(self) -> None:
        pass


def complete_groups(files: DataFrame, key: str, ts: str, kind: str, required: tuple[str, str], gap_seconds: int, delay: str) -> DataFrame:
    """X2 on arrival: ``group_key, first_file, last_change, n_files`` of each group, once both ``required`` kinds
    have come and then nothing for ``gap_seconds``; what comes later starts the group anew.

    Rows without a key or a time are no arrivals.  Rows later than ``delay``
    behind the newest are dropped by the watermark.  The session must use the RocksDB state store
    (``with_rocksdb``).
    """
    a, b = required
    arrivals = files.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).cast("string").alias("group_key"), F.col(ts).cast("timestamp").alias("at"),
        (F.col(kind) == a).alias("a"), (F.col(kind) == b).alias("b"),
    )
    arrivals = arrivals.withColumn("us", F.unix_micros("at")).fillna(False, ["a", "b"]).withWatermark("at", delay)
    return arrivals.groupBy("group_key").transformWithStateInPandas(
        statefulProcessor=QuietGroups(gap_seconds * 1_000_000), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )


class with_rocksdb:
    """The session with the RocksDB state store, which ``transformWithState`` needs, for the time of a block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(STATE_STORE)
        self.spark.conf.set(STATE_STORE, ROCKS)

    def __exit__(self, *_: object) -> None:
        self.spark.conf.set(STATE_STORE, self.before)


MANIFEST = T.StructType([T.StructField("group_key", T.StringType()), T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])


class GroupPublisher:
    """A ``foreachBatch`` sink for batches of ready groups (a column ``group_key`` naming a folder under
    ``landing``): publishes their files, then, on a later batch, deletes them.

    Under ``out``: the copied files in ``files/<group>/``, ``copied/batch=<n>`` and ``manifests/batch=<n>`` (what was
    published; written after the copies) and ``deleted/batch=<n>`` (whose sources are gone).  A replayed batch
    replaces its own uncommitted output.  Tasks copy and delete; the driver lists batch numbers only.
    """

    def __init__(self, spark: SparkSession, landing: str, out: str, exclude: tuple[str, ...] = ()):
        self.spark, self.landing, self.out, self.exclude = spark, landing.rstrip("/"), out, tuple(exclude)

    def __call__(self, ready: DataFrame, batch_id: int) -> None:
        self.sweep(before=batch_id)
        self.publish(ready, batch_id)

    def publish(self, ready: DataFrame, batch_id: int) -> None:
        """Phase one: the groups' files, then the manifest that makes them published."""
        if self._committed("manifests", batch_id):
            return
        groups = ready.filter(F.col("group_key").isNotNull()).select(F.concat(F.lit(self.landing + "/"), "group_key").alias("folder")).distinct()
        files = list_files(groups.repartition("folder"))
        listed = materialize(files.select(F.element_at(F.split("folder", "/"), -1).alias("group_key"), "path", "length"), "ready-files")
        name = F.element_at(F.split("path", "/"), -1)
        exported = listed.filter(~name.isin(*self.exclude)) if self.exclude else listed
        target = F.concat_ws("/", F.lit(f"{self.out}/files"), "group_key", name)
        copy_files(exported.withColumn("target", target)).write.mode("overwrite").parquet(self._folder("copied", batch_id))
        # Every file of a published group is named, also those that are not exported: all of them go.
        listed.write.mode("overwrite").parquet(self._folder("manifests", batch_id))

    def sweep(self, before: int | None = None) -> None:
        """Phase two: delete the files of groups in manifests committed by batches ``before`` this one."""
        for batch in self._batches("manifests"):
            if (before is not None and batch >= before) or self._committed("deleted", batch):
                continue
            named = self.spark.read.schema(MANIFEST).parquet(self._folder("manifests", batch))
            delete_files(named).write.mode("overwrite").parquet(self._folder("deleted", batch))

    def manifest(self) -> DataFrame:
        """Every published file with its batch and whether its source has been deleted."""
        batches = self._batches("manifests")
        if not batches:
            return self.spark.createDataFrame([], MANIFEST).withColumns({"batch": F.lit(0), "deleted": F.lit(False)})
        done = [b for b in batches if self._committed("deleted", b)]
        rows = self.spark.read.schema(T.StructType([*MANIFEST.fields, T.StructField("batch", T.IntegerType())])).option("basePath", f"{self.out}/manifests")
        rows = rows.parquet(*[self._folder("manifests", b) for b in batches])
        return rows.withColumn("deleted", F.col("batch").isin(*done) if done else F.lit(False))

    def _folder(self, what: str, batch: int) -> str:
        return os.path.join(self.out, what, f"batch={batch}")

    def _committed(self, what: str, batch: int) -> bool:
        return _exists(self.spark, os.path.join(self._folder(what, batch), "_SUCCESS"))

    def _batches(self, what: str) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(os.path.join(self.out, what, "batch=*"))
        store = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [int(s.getPath().getName().split("=")[1]) for s in store.globStatus(pattern) or []]
        return sorted(b for b in found if self._committed(what, b))
