"""Artifact resolution (N4/F7/L7), export filter (F8) and manifests (S5) on real temp files."""

import os

import pytest
from pyspark.sql import functions as F

from pairforge.operators import artifacts as A


def _write(root, rel, text):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_resolve_latest_valid(spark, scratch):
    root = os.path.join(scratch, "run")
    _write(root, "checkpoint-9/adapter_config.json", '{"r": 8}')
    _write(root, "checkpoint-10/adapter_config.json", '{"r": 8}')
    _write(root, "checkpoint-100/adapter_config.json", "")
    assert A.resolve_adapter_dir(spark, root) == os.path.join(root, "checkpoint-10")
    _write(root, "adapter_config.json", '{"root": true}')
    assert A.resolve_adapter_dir(spark, root) == root


def test_resolve_none_valid_raises(spark, scratch):
    root = os.path.join(scratch, "bad")
    _write(root, "checkpoint-1/adapter_config.json", "{not json")
    with pytest.raises(ValueError):
        A.resolve_adapter_dir(spark, root)
    assert A.resolve_adapter_dir(spark, "org/model-id") == "org/model-id"


def test_version_parsing(spark):
    df = spark.createDataFrame([("checkpoint-9",), ("checkpoint-x",), ("checkpoint-1_0",)], "n string")
    got = [r.v for r in df.select(A.checkpoint_version(F.col("n")).alias("v")).collect()]
    assert got == [9, None, 10]


def test_exportable_and_manifest(spark, scratch):
    root = os.path.join(scratch, "ck")
    _write(root, "checkpoint-1/adapter_model.safetensors", "w")
    _write(root, "checkpoint-1/optimizer.pt", "o")
    m = A.list_artifacts(spark, root)
    assert sorted(r.file for r in A.exportable(m).collect()) == ["adapter_model.safetensors"]
    assert {r.dir for r in m.collect()} == {"checkpoint-1"}


def test_resolver_looks_one_level_deep(spark, tmp_path):
    for folder in ("checkpoint-5", "backup/checkpoint-999"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "adapter_config.json").write_text("{}")
    assert A.resolve_adapter_dir(spark, str(tmp_path)) == str(tmp_path / "checkpoint-5")
    assert A.resolve_adapter_dir(spark, f"file:{tmp_path}") == f"file:{tmp_path}/checkpoint-5"


def test_runs_are_resolved_from_files(spark, scratch):
    root = os.path.join(scratch, "runs")
    for rel, text in (
        ("r1/checkpoint-9/adapter_config.json", "{}"), ("r1/checkpoint-9/adapter_model.safetensors", "weights"), ("r1/checkpoint-9/optimizer.pt", "state"),
        ("r1/checkpoint-10/adapter_config.json", "{cut"), ("r1/checkpoint-x/adapter_config.json", "{}"), ("r2/checkpoint-1/adapter_config.json", ""),
        ("r3/checkpoint-2/adapter_model.safetensors", "no config"),
    ):
        _write(root, rel, text)
    scan = A.scan_runs(spark, root)
    assert {r.length for r in scan.filter("run = 'r2'").collect()} == {0}  # empty files are listed
    got = {r.run: (r.n_checkpoints, r.n_valid, r.latest, r.n_files, r.n_bytes) for r in A.resolve_runs(scan).collect()}
    assert got == {"r1": (3, 2, "checkpoint-9", 2, 9), "r2": (1, 0, None, 0, 0), "r3": (1, 0, None, 0, 0)}


def test_no_listing_passes_through_the_driver(spark, scratch, monkeypatch):
    """tasks list and open the files, listings travel in batches, hidden folders' configs are not read."""
    from pairforge.sources import files as FL

    monkeypatch.setattr(FL, "LISTED", 2)
    rows = [(f"{scratch}/r/run-{i % 2}/{d}-{i}/adapter_config.json", b"" if i == 3 else b'{"r": 1}') for i in range(5) for d in ("checkpoint", "_hidden")]
    FL.write_files(spark.createDataFrame(rows, "path string, content binary")).collect()
    scan = A.scan_runs(spark, scratch + "/r")
    assert "binaryfile" not in scan._jdf.queryExecution().executedPlan().toString().lower()
    got = {(r.run, r.dir): r.valid for r in scan.collect()}
    assert got == {(f"run-{i % 2}", f"{d}-{i}"): d == "checkpoint" and i != 3 for i in range(5) for d in ("checkpoint", "_hidden")}
    content = {r.path: (r.length, bytes(r.content)) for r in FL.read_files(spark.createDataFrame([(p,) for p, _ in rows], "path string")).collect()}
    assert content == {p: (len(c), c) for p, c in rows}
    batches = FL.list_files(spark.createDataFrame([(f"{scratch}/r/run-{i}",) for i in (0, 1, 7)], "folder string").coalesce(1))
    assert sorted(r.path for r in batches.collect()) == sorted(p for p, _ in rows)
