"""Dense ids (N1), batch ids (N5) and their invariance under repartitioning."""

from pyspark.sql import functions as F

from pairforge.operators.positional import batch_ids, dense_index


def test_dense_index_matches_rank(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("v"))
    for parts in (1, 7, 64):
        got = dense_index(df.repartition(parts), ["k"], "pos", num_partitions=5).select("k", "pos").collect()
        by_k = sorted(got)
        assert [p for _, p in by_k] == list(range(5000))


def test_dense_index_empty(spark):
    df = spark.range(0).select(F.col("id").alias("k"))
    assert dense_index(df, ["k"], "pos").count() == 0


def test_batch_ids(spark):
    rows = spark.range(0, 19).select(batch_ids("id", 8).alias("b")).groupBy("b").count().orderBy("b").collect()
    assert [(r.b, r["count"]) for r in rows] == [(0, 8), (1, 8), (2, 3)]
