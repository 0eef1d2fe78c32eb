"""Sources and sinks."""

import os

import pytest

from pairforge.schemas import INSTRUCTION
from pairforge.sources import io


def _lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_source_exactly_one(spark):
    with pytest.raises(ValueError):
        io.read_rows(spark, INSTRUCTION)
    with pytest.raises(ValueError):
        io.read_rows(spark, INSTRUCTION, path="a", table="b")


def test_jsonl_roundtrip_blank_lines_and_failfast(spark, scratch):
    good = os.path.join(scratch, "good")
    _lines(good, ['{"example_id": 1, "instruction": "a", "input": "", "output": "o"}', "", "   ",
                  '{"example_id": 2, "instruction": "b", "input": "x", "output": "p"}'])
    rows = io.read_rows(spark, INSTRUCTION, path=good).orderBy("example_id").collect()
    assert [r.example_id for r in rows] == [1, 2]
    bad = os.path.join(scratch, "bad")
    _lines(bad, ['{"example_id": 1, "instruction": "a"}', "{not json"])
    with pytest.raises(Exception):
        io.read_rows(spark, INSTRUCTION, path=bad).collect()


def test_completed_ids_and_resume_append(spark, scratch):
    out = os.path.join(scratch, "out")
    assert io.completed_ids(spark, out).count() == 0
    df = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "example_id long, text string")
    io.append_pending(spark, df.filter("example_id < 3"), out, 0)
    written = io.append_pending(spark, df, out, 1)
    assert sorted(r.example_id for r in written.collect()) == [3, 4]
    assert sorted(r.example_id for r in io.completed_ids(spark, out).collect()) == [0, 1, 2, 3, 4]
    # a committed chunk is never replaced: the same id, resumed, adds only what is missing
    more = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "example_id long, text string")
    io.append_pending(spark, more, out, 1)
    assert sorted(r.example_id for r in io.completed_ids(spark, out).collect()) == [0, 1, 2, 3, 4, 5, 6]


def test_summary_and_publish(spark, scratch):
    src = os.path.join(scratch, "rows")
    _lines(src, ['{"example_id": 7, "instruction": "a", "input": "", "output": "o"}'])
    with pytest.raises(ValueError):
        io.publish(spark, src, INSTRUCTION, None)
    pub = io.publish(spark, src, INSTRUCTION, os.path.join(scratch, "pub"))
    assert pub.count() == 1
    io.write_summary(pub.groupBy().count(), os.path.join(scratch, "summary"))
    assert spark.read.json(os.path.join(scratch, "summary")).first()["count"] == 1


def test_config_mismatch_audit(spark):
    from pyspark.sql import functions as F

    from pairforge.operators.joins import config_mismatches

    df = spark.createDataFrame([(1, "m", 42), (2, "m", 7), (3, "x", 42)], "example_id long, model_id string, seed long")
    gen = df.select("example_id", F.struct("model_id", "seed").alias("gen_config"))
    r = config_mismatches(gen, model_id="m", seed=42).first()
    assert (r.n_rows, r.n_config_mismatch) == (3, 2)


def test_bad_lines_names_file_and_line(spark, scratch):
    folder = os.path.join(scratch, "in")
    good = '{"example_id": 1, "instruction": "a", "input": "", "output": "o"}'
    _lines(folder, [good, "", "{cut", good, '{"example_id": "x"}', "   ", "[1, 2]", '"text"'])
    with open(os.path.join(folder, "part-1.jsonl"), "w") as f:
        f.write("{only" + "\n" + (good + "\n") * 5000 + "{last")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for block in (before, "16k"):  # whole files, and files in many blocks
            spark.conf.set("spark.sql.files.maxPartitionBytes", block)
            got = sorted((os.path.basename(r.file), r.line, r.raw) for r in io.bad_lines(spark, folder, INSTRUCTION).collect())
            assert [(f, n) for f, n, _ in got if f == "part-1.jsonl"] == [("part-1.jsonl", 1), ("part-1.jsonl", 5002)]
            assert [(n, raw) for f, n, raw in got if f == "part-0.jsonl"][:2] == [(3, "{cut"), (5, '{"example_id": "x"}')]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    clean = os.path.join(scratch, "clean")
    _lines(clean, [good])
    assert io.bad_lines(spark, clean, INSTRUCTION).count() == 0
