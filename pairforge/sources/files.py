"""Named files written, copied and deleted by tasks, through any store that ``pyarrow.fs`` knows.

Spark's writers choose their own file names; artifacts have fixed ones.  Each helper is a narrow Python map
over (path, ...) rows that may run again after a lost executor: writing and copying replace the whole file,
deleting a file that is gone is done already.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 1 << 22
#: Rows of a listing that are sent on together.
LISTED = 10_000


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """(store, path within it) of a path with or without a scheme; Spark writes ``file:/`` with one slash."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _open_for_writing(path: str):
    store, name = store_of(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    return store.open_output_stream(name)


def write_files(df: DataFrame) -> DataFrame:
    """Write ``content`` (binary) to ``path`` for every row; returns ``path, length`` (lazy)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                with _open_for_writing(path) as out:
                    out.write(bytes(content))
            yield pd.DataFrame({"path": frame["path"], "length": [len(c) for c in frame["content"]]})

    return df.select("path", "content").mapInPandas(run, "path string, length bigint")


def list_files(df: DataFrame, recursive: bool = True, folders: bool = False) -> DataFrame:
    """Every file below ``folder`` of each row as ``folder, path, length, mtime`` (or, with ``folders``, every
    folder); a folder that does not exist has none.  Unlike Spark's file sources this lists empty files too."""

    wanted = pafs.FileType.Directory if folders else pafs.FileType.File
    schema = pa.schema([("folder", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("mtime", pa.timestamp("us", "UTC"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                store, name = store_of(folder)
                head = folder.rstrip("/").removesuffix(name.rstrip("/"))  # the scheme, as it was given
                found = [f for f in store.get_file_info(pafs.FileSelector(name, recursive=recursive, allow_not_found=True)) if f.type == wanted]
                rows += [{"folder": folder, "path": head + f.path, "length": f.size or 0, "mtime": f.mtime} for f in found]
                while len(rows) >= LISTED:
                    yield pa.RecordBatch.from_pylist(rows[:LISTED], schema=schema)
                    rows = rows[LISTED:]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return df.select("folder").mapInArrow(run, "folder string, path string, length bigint, mtime timestamp")


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every file under ``root``: its folders are listed first, then their contents by as many tasks."""
    top = spark.createDataFrame([(root,)], "folder string")
    below = list_files(top, recursive=False, folders=True).select(F.col("path").alias("folder"))
    return list_files(top, recursive=False).unionByName(list_files(below.repartition(spark.sparkContext.defaultParallelism, "folder"))).drop("folder")


def read_files(df: DataFrame) -> DataFrame:
    """``path, length, content`` (binary) of the file of every row: tasks open them, the driver lists nothing."""

    def rows(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
        columns = [pa.array(paths, pa.string()), pa.array([len(c) for c in contents], pa.int64()), pa.array(contents, pa.binary())]
        return pa.record_batch(columns, ["path", "length", "content"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, contents, size = [], [], 0
            for path in batch.column("path").to_pylist():
                store, name = store_of(path)
                with store.open_input_stream(name) as source:
                    content = source.read()
                paths.append(path)
                contents.append(content)
                size += len(content)
                if size >= PIECE:
                    yield rows(paths, contents)
                    paths, contents, size = [], [], 0
            yield rows(paths, contents)

    return df.select("path").mapInArrow(run, "path string, length bigint, content binary")


def copy_files(df: DataFrame) -> DataFrame:
    """Copy ``path`` to ``target`` for every row, piece by piece; returns ``path, target, length`` (lazy)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = []
            for path, target in zip(frame["path"], frame["target"], strict=True):
                store, name = store_of(path)
                size = 0
                with store.open_input_stream(name) as source, _open_for_writing(target) as out:
                    while piece := source.read(PIECE):
                        out.write(piece)
                        size += len(piece)
                sizes.append(size)
            yield pd.DataFrame({"path": frame["path"], "target": frame["target"], "length": sizes})

    return df.select("path", "target").mapInPandas(run, "path string, target string, length bigint")


def delete_files(df: DataFrame) -> DataFrame:
    """Delete ``path`` for every row; returns ``path, deleted`` (lazy): false if it was gone already."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            deleted = []
            for path in frame["path"]:
                store, name = store_of(path)
                deleted.append(store.get_file_info(name).type != pafs.FileType.NotFound)
                if deleted[-1]:
                    store.delete_file(name)
            yield pd.DataFrame({"path": frame["path"], "deleted": deleted})

    return df.select("path").mapInPandas(run, "path string, deleted boolean")
