"""Complete groups with state (X2) and two-phase publishing."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pairforge.sources import files as FL
from pairforge.streaming import arrivals as AR
from pairforge.streaming import streams as X

GAP, DELAY = 3600, 600
START = datetime(2024, 1, 1)


def expected(rows, newest):
    """Fold each group's quiet runs in order; a run counts once a gap and the delay have passed after it."""
    out = []
    for key in {k for k, t, _ in rows if k is not None and t is not None}:
        mine = sorted((t, kind) for k, t, kind in rows if k == key and t is not None)
        runs = []
        for t, kind in mine:
            if runs and t - runs[-1][-1][0] < timedelta(seconds=GAP):
                runs[-1].append((t, kind))
            else:
                runs.append([(t, kind)])
        held = []
        for run in runs:
            if run[-1][0] + timedelta(seconds=GAP) > newest - timedelta(seconds=DELAY):
                break
            held += run
            if {"cfg", "bin"} <= {k for _, k in held}:
                out.append((str(key), held[0][0], run[-1][0], len(held)))
                held = []
    return sorted(out)


def arrivals_of():
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3, 3, 3]), START + timedelta(seconds=rng.randint(0, 200_000), microseconds=rng.randint(0, 999_999)), rng.choice(["cfg", "bin", "other", None])) for _ in range(120)]
    rows += [(9, START, "cfg"), (9, START + timedelta(hours=5), "bin"), (9, START + timedelta(hours=5), "bin"), (8, START, "cfg"), (None, START, "cfg"), (7, None, "bin")]
    return sorted(rows, key=lambda r: r[1] or START)


def _land(spark, rows, folder):
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, kind string").select("k", F.col("ts").cast("timestamp").alias("ts"), "kind")
    df.coalesce(1).write.mode("append").parquet(folder)


def _run(spark, src, out, checkpoint, files=1):
    with AR.with_rocksdb(spark):
        stream = X.file_stream(spark, src, "k long, ts timestamp, kind string", "parquet", max_files_per_trigger=files)
        X.run_append(AR.complete_groups(stream, "k", "ts", "kind", ("cfg", "bin"), GAP, f"{DELAY} seconds"), out, checkpoint, state_partitions=2)
    return sorted((r.group_key, r.first_file, r.last_change, r.n_files) for r in spark.read.schema(AR.OUTPUT).parquet(out).collect())


def test_groups_across_batches_and_a_restart_with_state(spark, scratch):
    rows = arrivals_of()
    src, out, checkpoint = scratch + "/in", scratch + "/out", scratch + "/ck"
    for at in range(0, 60, 20):
        _land(spark, rows[at : at + 20], src)
    half = _run(spark, src, out, checkpoint)
    for at in range(60, len(rows), 20):  # the query stopped; more arrives; it goes on from its state
        _land(spark, rows[at : at + 20], src)
    got = _run(spark, src, out, checkpoint)
    newest = max(r[1] for r in rows if r[1])
    assert got == expected(rows, newest) and len(got) > len(half) > 0
    assert ("9", START, START + timedelta(hours=5), 3) in got  # files five hours apart: no session window holds both


def test_one_batch_gives_the_same(spark, scratch):
    rows = arrivals_of()
    random.Random(1).shuffle(rows)
    _land(spark, rows, scratch + "/in")
    assert _run(spark, scratch + "/in", scratch + "/out", scratch + "/ck") == expected(rows, max(r[1] for r in rows if r[1]))


def test_runs_merge_in_any_order():
    runs = [(10, 12, 1, True, False), (0, 1, 2, False, False), (3, 9, 1, False, True), (40, 40, 1, True, True)]
    for _ in range(5):
        random.shuffle(runs)
        assert AR.merged_runs(runs, 5) == [(0, 12, 4, True, True), (40, 40, 1, True, True)]
    assert AR.merged_runs([(0, 0, 1, True, False), (5, 5, 1, False, True)], 5) == [(0, 0, 1, True, False), (5, 5, 1, False, True)]


def _landing(spark, root, groups):
    rows = [(f"{root}/{g}/{n}", f"{g}{n}".encode()) for g in groups for n in ("adapter_config.json", "adapter_model.safetensors", "optimizer.pt")]
    FL.write_files(spark.createDataFrame(rows, "path string, content binary")).collect()


def _found(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.startswith((".", "_")))


def _ready(spark, *groups):
    return spark.createDataFrame([(g,) for g in groups], "group_key string")


def test_publish_then_delete_on_a_later_batch(spark, scratch):
    landing, out = scratch + "/landing", scratch + "/out"
    _landing(spark, landing, ["a", "b", "c"])
    p = AR.GroupPublisher(spark, landing, out, exclude=("optimizer.pt",))
    p(_ready(spark, "a", "a"), 0)
    assert len(_found(landing)) == 9 and _found(out + "/files") == ["a/adapter_config.json", "a/adapter_model.safetensors"]
    p(_ready(spark, "b"), 1)  # now batch 0's sources go
    assert {f.split("/")[0] for f in _found(landing)} == {"b", "c"}
    p.sweep()
    assert {f.split("/")[0] for f in _found(landing)} == {"c"}
    assert open(out + "/files/b/adapter_config.json").read() == "badapter_config.json"
    assert sorted((r.group_key, r.batch, r.deleted) for r in p.manifest().collect()) == [("a", 0, True)] * 3 + [("b", 1, True)] * 3
    p.sweep()  # nothing left to do


def test_a_failure_between_the_phases_loses_and_deletes_nothing(spark, scratch, monkeypatch):
    landing, out = scratch + "/landing", scratch + "/out"
    _landing(spark, landing, ["a", "b"])
    p = AR.GroupPublisher(spark, landing, out)
    real = p._folder
    # Dies after the copies, before the manifest: not published, nothing deleted; the replay publishes it.
    monkeypatch.setattr(p, "_folder", lambda what, batch: real(what, batch) if what != "manifests" or p.__dict__.get("armed") else (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        p(_ready(spark, "a"), 0)
    monkeypatch.undo()
    p.sweep()
    assert len(_found(landing)) == 6 and p.manifest().count() == 0
    p(_ready(spark, "a"), 0)
    # Dies while deleting: the manifest names what is left, and the next sweep finishes it.
    os.remove(f"{landing}/a/optimizer.pt")
    monkeypatch.setattr(AR, "delete_files", lambda df: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        p(_ready(spark, "b"), 1)
    monkeypatch.undo()
    assert len(_found(landing)) == 5 and not p.manifest().filter("deleted").count()
    p(_ready(spark, "b"), 1)
    p(_ready(spark, "b"), 1)  # a replayed batch publishes nothing twice
    p.sweep()
    assert _found(landing) == [] and p.manifest().filter("deleted").count() == 6 and len(_found(out + "/files")) == 6


def test_nothing_ready(spark, scratch):
    _landing(spark, scratch + "/landing", ["a"])
    p = AR.GroupPublisher(spark, scratch + "/landing", scratch + "/out")
    assert p.manifest().count() == 0
    p(_ready(spark), 0)
    p.sweep()
    assert len(_found(scratch + "/landing")) == 3 and p.manifest().count() == 0


class _Handle:
    """State and timers of one group, with the number of calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def _call(self):
        self.calls += 1

    def get(self):
        self._call()
        return self.value

    def update(self, value):
        self._call()
        self.value = value

    def clear(self):
        self._call()
        self.value = None

    def registerTimer(self, at):
        self._call()
        self.timers.add(at)

    def deleteTimer(self, at):
        self._call()
        self.timers.discard(at)


def test_calls_for_state_do_not_grow_with_a_groups_runs():
    """a call is a round trip to the JVM; a group with 400 runs needs as few as one with a single run."""
    import pandas as pd

    class Times:
        def getCurrentWatermarkInMs(self):
            return 10**9

    for runs in (1, 400):
        handle, groups = _Handle(), AR.QuietGroups(10)
        groups.init(handle)
        frames = [pd.DataFrame({"us": [100 * i + k for i in range(runs)], "a": [True] * runs, "b": [i % 2 == 0 for i in range(runs)]}) for k in (3, 1)]
        assert list(groups.handleInputRows(("g",), iter(frames), None)) == [] and handle.calls <= 3 and len(handle.timers) == 1
        out = pd.concat(groups.handleExpiredTimer(("g",), Times(), None))
        assert handle.calls <= 6 and not handle.timers
        assert out["n_files"].sum() == 2 * runs - 2 * (runs > 1) and len(out) == (runs + 1) // 2  # the last run has no second kind yet
        assert (handle.value is None) == (runs == 1)


def test_bursts_in_any_order():
    import numpy as np

    us = np.array([40, 0, 9, 22, 1])
    a, b = np.array([False, True, False, True, False]), np.array([True, False, False, False, False])
    assert AR.bursts(us, a, b, 10) == [(0, 9, 3, True, False), (22, 22, 1, True, False), (40, 40, 1, False, True)]
    assert AR.bursts(us[:0], a[:0], b[:0], 10) == []
