"""S4 + D1: the written output's ids as a bucketed table, so that resuming does not shuffle them.

The reference re-reads its whole output file to know which ids are done.  Here every committed chunk also
appends its ids to a Parquet table that is bucketed and sorted by the id.  The resume anti-join then reads
the done side bucket by bucket, with no exchange over it however many runs have been written; only the
pending candidates are dealt to the buckets.  Each file carries a Bloom filter of its ids, so that looking
up a few ids skips the row groups of all other runs.

The order of a chunk is: rows first, ids second.  A run that dies between the two is found by its chunk
number, which the id table lacks, and ``recover`` adds its ids from the chunk that is already there.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.sources.io import _exists

CHUNK = "chunk"


def _sql_type(t: T.DataType) -> str:
    if not isinstance(t, (T.IntegralType, T.StringType)):
        raise ValueError(f"ids must be integers or strings, not {t.simpleString()}")
    return t.simpleString()


@dataclass
class ResumableOutput:
    """Chunks of rows under ``path/rows`` and their ids, bucketed by ``key``, under ``path/done``.

    ``buckets`` is fixed when the output is new; it should be at least the shuffle width of the runs that
    will resume from it.  The table is known to the session's catalog under a name of its own; another
    session, or another cluster, registers the same files again by opening the same path.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str = "example_id"
    buckets: int = 64
    table: str = field(init=False)

    def __post_init__(self) -> None:
        self.rows_path, self.done_path = os.path.join(self.path, "rows"), os.path.join(self.path, "done")
        self.table = "done_" + re.sub(r"\W", "_", uuid.uuid4().hex)
        kind = _sql_type(self.schema[self.key].dataType)
        made = os.path.join(self.path, "buckets")
        if _exists(self.spark, made):
            self.buckets = int(self.spark.read.text(made).first()[0])
        else:
            self.spark.createDataFrame([(str(self.buckets),)], "value string").coalesce(1).write.text(made)
        self.spark.sql(
            f"CREATE TABLE {self.table} (`{self.key}` {kind}, `{CHUNK}` STRING) USING parquet "
            f"OPTIONS ('parquet.bloom.filter.enabled#{self.key}' 'true') "
            f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.done_path}'"
        )

    def done(self) -> DataFrame:
        """The ids of all committed chunks (one row each time an id was written); nothing yet, no rows."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def pending(self, rows: DataFrame) -> DataFrame:
        """Rows whose key is not done; a null key is never done.  Place it before any model."""
        return rows.join(self.done().select(self.key), self.key, "left_anti")

    def commit(self, rows: DataFrame, chunk: str) -> DataFrame:
        """Write ``rows`` as chunk ``chunk``, then its ids; returns the written rows.  A committed chunk
        is never written again; an uncommitted one is replaced."""
        if not self._committed(chunk):
            rows.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(chunk))
        self._add_ids(chunk)
        return self.spark.read.schema(self.schema).parquet(self._folder(chunk))

    def recover(self, chunk: str) -> bool:
        """Add the ids of a chunk whose run died after its rows; whether there was one."""
        if not self._committed(chunk) or not self.done().filter(F.col(CHUNK) == chunk).isEmpty():
            return False
        self._add_ids(chunk)
        return True

    def rows(self) -> DataFrame:
        """All rows of all chunks, with the chunk they came in."""
        if not _exists(self.spark, self.rows_path):
            return self.spark.createDataFrame([], self.schema).withColumn(CHUNK, F.lit(None).cast("string"))
        schema = T.StructType([*self.schema.fields, T.StructField(CHUNK, T.StringType())])
        return self.spark.read.schema(schema).parquet(self.rows_path)

    def _folder(self, chunk: str) -> str:
        return os.path.join(self.rows_path, f"{CHUNK}={chunk}")

    def _committed(self, chunk: str) -> bool:
        return _exists(self.spark, os.path.join(self._folder(chunk), "_SUCCESS"))

    def _add_ids(self, chunk: str) -> None:
        if not self.done().filter(F.col(CHUNK) == chunk).isEmpty():
            return
        ids = self.spark.read.schema(T.StructType([self.schema[self.key]])).parquet(self._folder(chunk)).filter(F.col(self.key).isNotNull())
        # One task a bucket writes one sorted file; without it every task would write a file for every bucket.
        ids = ids.repartition(self.buckets, self.key).withColumn(CHUNK, F.lit(chunk))
        ids.write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
