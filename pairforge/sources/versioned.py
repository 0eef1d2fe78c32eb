"""K1/K2/K4: a sink whose output changes only as a whole, as a Python data source with commit and abort.

``df.write.format("versioned").option("path", p).mode("append" | "overwrite").save()`` writes Parquet part files
under ``p/data`` from the tasks and, when all of them are done, one manifest ``p/versions/<n>.json`` that lists
the files of version ``n``: those of the version before plus the new ones (append), or the new ones only
(overwrite).  A manifest is written under another name and then moved into place, and a version number that
another writer has taken meanwhile is an error, not an overwrite.  Readers take the newest manifest, so they see
the last committed version while a writer runs and after it has failed; an aborted write removes its own files.

A ``chunk`` option names the write.  A chunk that an earlier version holds is not added a second time, so a run
may repeat its last append without knowing whether it went through.

Tasks and driver reach the files through ``pyarrow.fs``, so any store it knows will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from pairforge.sources.files import store_of

DIGITS = 12


def _base(path: str) -> tuple[pafs.FileSystem, str]:
    return store_of(path.rstrip("/"))


def versions(path: str) -> list[int]:
    """The committed version numbers, ascending."""
    store, base = _base(path)
    found = store.get_file_info(pafs.FileSelector(f"{base}/versions", allow_not_found=True))
    return sorted(int(f.base_name.split(".")[0]) for f in found if f.base_name.endswith(".json") and f.base_name.split(".")[0].isdigit())


def manifest(path: str, version: int | None = None) -> dict:
    """``{"version", "files", "chunks"}`` of a committed version (the newest); version 0 is empty."""
    known = versions(path)
    version = (known[-1] if known else 0) if version is None else version
    if version == 0:
        return {"version": 0, "files": [], "chunks": []}
    store, base = _base(path)
    with store.open_input_stream(f"{base}/versions/{version:0{DIGITS}d}.json") as f:
        return json.loads(f.read())


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class VersionedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool, chunk: str | None):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.overwrite, self.chunk = path, overwrite, chunk
        self.schema = to_arrow_schema(schema)
        self.before = manifest(path)["version"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = _base(self.path)
        store.create_dir(f"{base}/data", recursive=True)
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                if out is None:
                    out = pq.ParquetWriter(f"{base}/data/{name}", self.schema, filesystem=store, compression="zstd")
                out.write_table(pa.Table.from_batches([batch]).cast(self.schema))
                rows += batch.num_rows
        except BaseException:
            if out is not None:
                out.close()
                store.delete_file(f"{base}/data/{name}")
            raise
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        new = [m.file for m in messages if m is not None and m.file]
        old = manifest(self.path)
        if self.chunk is not None and self.chunk in old["chunks"] and not self.overwrite:
            self._remove(new)  # this chunk went through before
            return
        if old["version"] != self.before:
            self._remove(new)
            raise RuntimeError(f"another writer committed version {old['version']} of {self.path}")
        chunks = [*([] if self.overwrite else old["chunks"]), *([self.chunk] if self.chunk is not None else [])]
        files = new if self.overwrite else [*old["files"], *new]
        self._put({"version": self.before + 1, "files": files, "chunks": chunks})

    def abort(self, messages: list[Written | None]) -> None:
        self._remove([m.file for m in messages if m is not None and m.file])

    def _put(self, what: dict) -> None:
        store, base = _base(self.path)
        store.create_dir(f"{base}/versions", recursive=True)
        scratch, target = f"{base}/versions/{uuid.uuid4().hex}.tmp", f"{base}/versions/{what['version']:0{DIGITS}d}.json"
        with store.open_output_stream(scratch) as f:
            f.write(json.dumps(what).encode())
        if store.get_file_info(target).type != pafs.FileType.NotFound:
            store.delete_file(scratch)
            raise RuntimeError(f"version {what['version']} of {self.path} exists already")
        store.move(scratch, target)

    def _remove(self, names: list[str]) -> None:
        store, base = _base(self.path)
        for name in names:
            if store.get_file_info(f"{base}/data/{name}").type != pafs.FileType.NotFound:
                store.delete_file(f"{base}/data/{name}")


@dataclass
class _File(InputPartition):
    name: str


class VersionedReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, version: int | None):
        self.path, self.names, self.files = path, schema.names, manifest(path, version)["files"]

    def partitions(self) -> list[_File]:
        return [_File(name) for name in self.files] or [_File("")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if partition.name:
            store, base = _base(self.path)
            with store.open_input_file(f"{base}/data/{partition.name}") as f:
                yield from pq.ParquetFile(f).iter_batches(columns=self.names)


class VersionedSource(DataSource):
    """Options: ``path``; writing ``chunk``; reading ``version`` (default: the newest)."""

    @classmethod
    def name(cls) -> str:
        return "versioned"

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        version = self.options.get("version")
        files = manifest(self.options["path"], None if version is None else int(version))["files"]
        if not files:
            raise ValueError("give a schema: the version holds no file")
        store, base = _base(self.options["path"])
        with store.open_input_file(f"{base}/data/{files[0]}") as f:
            return from_arrow_schema(pq.ParquetFile(f).schema_arrow)

    def writer(self, schema: T.StructType, overwrite: bool) -> VersionedWriter:
        return VersionedWriter(self.options["path"], schema, overwrite, self.options.get("chunk"))

    def reader(self, schema: T.StructType) -> VersionedReader:
        version = self.options.get("version")
        return VersionedReader(self.options["path"], schema, None if version is None else int(version))


def write_version(df: DataFrame, path: str, mode: str = "append", chunk: str | None = None) -> int:
    """Commit ``df`` as the next version of ``path``; returns the version that readers now see."""
    df.sparkSession.dataSource.register(VersionedSource)
    writer = df.write.format("versioned").mode(mode).option("path", path)
    (writer if chunk is None else writer.option("chunk", chunk)).save()
    return manifest(path)["version"]


def read_version(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None, native: bool = True) -> DataFrame:
    """The rows of the newest version, or of ``version``.  ``native`` hands the manifest's files to Spark's own
    Parquet reader, which prunes columns and pushes filters; otherwise they are read through the data source."""
    if native:
        store, base = _base(path)
        files = [f"{base}/data/{name}" for name in manifest(path, version)["files"]]
        scheme = path.split(":", 1)[0] + "://" if ":" in path and not path.startswith("file:") else "file://"
        return spark.read.schema(schema).parquet(*[scheme + f for f in files]) if files else spark.createDataFrame([], schema)
    spark.dataSource.register(VersionedSource)
    reader = spark.read.format("versioned").schema(schema).option("path", path)
    return (reader if version is None else reader.option("version", version)).load()
