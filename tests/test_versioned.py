"""The committing sink (K1, K2, K4): versions, repeated chunks, aborted and racing writers."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.sources import versioned as V

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))])


def _rows(spark, ids):
    return spark.createDataFrame([(i, None if i % 5 == 0 else f"t{i} é", [str(i), "x"]) for i in ids], SCHEMA).repartition(3)


def _ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("native", [True, False])
def test_append_overwrite_and_time_travel(spark, scratch, native):
    path = scratch + "/out"
    assert V.versions(path) == [] and _ids(V.read_version(spark, path, SCHEMA, native=native)) == []
    assert V.write_version(_rows(spark, range(10)), path) == 1
    assert V.write_version(_rows(spark, range(10, 13)), "file:" + path) == 2
    assert V.write_version(_rows(spark, [99]), path, "overwrite") == 3
    assert V.write_version(_rows(spark, []), path) == 4
    read = lambda v=None: V.read_version(spark, path, SCHEMA, v, native)
    assert [_ids(read(v)) for v in (1, 2, 3, None)] == [list(range(10)), list(range(13)), [99], [99]]
    rows = {r.id: r for r in read(2).collect()}
    assert rows[5].text is None and rows[6].text == "t6 é" and rows[6].tags == ["6", "x"]
    assert read(2).select("tags", "id").filter(F.col("id") == 3).collect()[0].tags == ["3", "x"]


def test_a_repeated_chunk_is_written_once(spark, scratch):
    path = scratch + "/out"
    V.write_version(_rows(spark, range(4)), path, chunk="a")
    assert V.write_version(_rows(spark, range(4)), path, chunk="a") == 1
    assert V.write_version(_rows(spark, range(4, 6)), path, chunk="b") == 2
    assert _ids(V.read_version(spark, path, SCHEMA)) == list(range(6))
    assert len(os.listdir(path + "/data")) == len(V.manifest(path)["files"])  # the repeated files were removed


def test_a_failed_write_leaves_the_last_version_and_no_files(spark, scratch):
    path = scratch + "/out"
    V.write_version(_rows(spark, range(6)), path)
    before = sorted(os.listdir(path + "/data"))
    broken = _rows(spark, range(100, 200)).withColumn("text", F.when(F.col("id") == 150, F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("text")))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="boom"):
            V.write_version(broken, path, mode)
        assert V.versions(path) == [1] and _ids(V.read_version(spark, path, SCHEMA)) == list(range(6))
    kept = sorted(os.listdir(path + "/data"))
    assert set(before) <= set(kept) and _ids(spark.read.schema(SCHEMA).parquet(*[f"{path}/data/{f}" for f in before])) == list(range(6))


def test_racing_writers_do_not_overwrite(spark, scratch):
    path = scratch + "/out"
    first = V.VersionedWriter(path, SCHEMA, False, None)
    second = V.VersionedWriter(path, SCHEMA, False, None)
    batch = _rows(spark, [1]).toArrow().cast(first.schema).to_batches()
    a, b = first.write(iter(batch)), second.write(iter(batch))
    first.commit([a, None])
    with pytest.raises(RuntimeError, match="another writer"):
        second.commit([b])
    assert V.versions(path) == [1] and V.manifest(path)["files"] == [a.file] and os.listdir(path + "/data") == [a.file]
    third = V.VersionedWriter(path, SCHEMA, True, None)
    third.abort([third.write(iter(batch)), None])
    assert os.listdir(path + "/data") == [a.file]


def test_source_infers_and_needs_a_file(spark, scratch):
    path = scratch + "/out"
    V.write_version(_rows(spark, [1, 2]), path)
    spark.dataSource.register(V.VersionedSource)
    assert spark.read.format("versioned").option("path", path).load().schema.names == SCHEMA.names
    V.write_version(_rows(spark, []), path, "overwrite")
    with pytest.raises(Exception, match="schema"):
        spark.read.format("versioned").option("path", path).load()
