"""Exact order statistics by radix histograms (L3, L4): against a sort, with ties, nulls and repeated keys."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from pairforge.operators import sampling as SM
from pairforge.operators.selection import find_cut, mark_smallest


def _md5(seed, k):
    return hashlib.md5(f"{seed}:{k}".encode()).hexdigest()


@pytest.mark.parametrize("digits,few", [(4, 4096), (1, 1), (2, 3), (3, 1)])
@pytest.mark.parametrize("n", [1, 7, 250, 499])
def test_cut_equals_a_sort(spark, digits, few, n):
    df = spark.range(0, 500).withColumnRenamed("id", "k").repartition(7)
    order = sorted((_md5(42, k), k) for k in range(500))
    cut, total = find_cut(df, SM.seeded_hash("k", 42), "k", lambda _: n, digits, few)
    assert total == 500 and (cut.hash, cut.key, cut.take, cut.equal) == (*order[n - 1], 1, 1)


def test_nothing_and_everything(spark):
    df = spark.range(0, 9).withColumnRenamed("id", "k")
    for wanted, count in ((0, 0), (9, 9), (12, 9)):
        marked, total = mark_smallest(df, SM.seeded_hash("k", 1), "k", lambda _, w=wanted: w, "m")
        assert total == 9 and marked.filter("m").count() == count
    marked, total = mark_smallest(df.limit(0), SM.seeded_hash("k", 1), "k", lambda t: math.ceil(t / 2), "m")
    assert total == 0 and marked.count() == 0


def test_repeated_and_null_keys_are_divided_exactly(spark):
    """A third of all rows share a key, some have none; sizes stay exact at every rank, and null keys come first."""
    rows = [(i % 4 if i < 40 else 77 if i < 100 else i, f"v{i}", "x") for i in range(150)] + [(None, "n", "x")] * 5
    df = spark.createDataFrame(rows, "k long, v string, split string").repartition(5)
    for n in (0, 1, 4, 5, 6, 40, 63, 64, 65, 100, 154, 155):
        marked, total = mark_smallest(df, SM.seeded_hash("k", 3), "k", lambda _, n=n: n, "m")
        got = marked.collect()
        assert total == 155 and len(got) == 155 and sum(r.m for r in got) == n
        assert sorted((r.k is None, r.k or 0, r.v) for r in got) == sorted((k is None, k or 0, v) for k, v, _ in rows)
        order = [("" if k is None else _md5(3, k)) for k, *_ in rows]
        assert sorted("" if r.k is None else _md5(3, r.k) for r in got if r.m) == sorted(order)[:n]
        if 0 < n < 5:
            assert all(r.k is None for r in got if r.m)


def test_split_plan_has_no_exchange_and_no_sort(spark, scratch):
    spark.range(0, 2000).select(F.col("id").alias("k"), F.repeat(F.lit("text "), 50).alias("text")).write.parquet(scratch + "/t")
    df = spark.read.parquet(scratch + "/t")
    split = SM.split_exact(df, "k")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert split.filter("split = 'test'").count() == 100
    counted = find_cut.__module__ and df.select(F.col("k"))
    assert "ReadSchema: struct<k:bigint>" in counted._jdf.queryExecution().executedPlan().toString()


def test_shuffle_take_equals_the_full_shuffle(spark):
    df = spark.range(0, 300).withColumnRenamed("id", "k").repartition(3)
    full = {r.k: r.position for r in SM.shuffle_positions(df, "k", 5).collect()}
    took = {r.k: r.position for r in SM.shuffle_take(df, "k", 120, 5).collect()}
    assert took == {k: p for k, p in full.items() if p < 120}
    with pytest.raises(ValueError, match="300 available"):
        SM.shuffle_take(df, "k", 301)


def test_string_keys_and_counting_another_table(spark):
    df = spark.createDataFrame([(f"k{i}é",) for i in range(60)], "k string")
    order = sorted((_md5(42, f"k{i}é"), f"k{i}é") for i in range(60))
    got = {r.k for r in SM.split_exact(df, "k", 0.2, keys=df.repartition(2)).filter("split = 'test'").collect()}
    assert got == {k for _, k in order[:12]}
