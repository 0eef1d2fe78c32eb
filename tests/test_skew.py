"""Skewed inputs (one key holding a third of the rows) keep exact, dense, deterministic results."""

from pyspark.sql import functions as F

from pairforge.operators.positional import dense_index
from pairforge.sources.tables import examples_from_conversations


def _conversations(spark):
    # conversation 0 holds a third of all turns; the rest are short user/assistant exchanges
    big = spark.range(0, 3000).select(
        F.lit(0).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
    )
    small = spark.range(0, 6000).select(
        (F.floor(F.col("id") / 2) + 1).cast("long").alias("conv_id"), (F.col("id") % 2).alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("text"),
    )
    sys_turn = spark.createDataFrame([(0, -1, "system", "be brief")], "conv_id long, turn long, role string, text string")
    return big.unionByName(small).unionByName(sys_turn)


def test_examples_under_skew(spark):
    rows = examples_from_conversations(_conversations(spark).repartition(16))
    ex = dense_index(rows, ["conv_id", "turn"], "example_id")
    got = ex.select("example_id", "conv_id", "turn", "input").collect()
    assert len(got) == 1500 + 3000
    assert sorted(r.example_id for r in got) == list(range(4500))
    first = {(r.conv_id, r.turn): r.example_id for r in got}
    assert first[(0, 0)] == 0 and first[(1, 0)] == 1500
    assert all(r.input == "be brief" for r in got if r.conv_id == 0)
    again = dense_index(rows, ["conv_id", "turn"], "example_id").select("conv_id", "turn", "example_id").collect()
    assert {(r.conv_id, r.turn): r.example_id for r in again} == first
