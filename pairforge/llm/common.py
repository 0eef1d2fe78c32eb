"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.session import materialize

__all__ = ["table", "materialize", "hash_order_sample", "join_small_by_key", "row_lists", "shuffle_width"]


#: What modules keep in a Python worker between tasks, by stage name: how to free it.
CACHES: dict[str, Callable[[], None]] = {}
_STAGE = [""]


def stage_begins(name: str) -> None:
    """Called first in a task.  Spark reuses Python workers for later stages, so what another operator's
    stage kept there is freed, and free memory goes back to the system."""
    if _STAGE[0] == name:
        return
    _STAGE[0] = name
    for owner, clear in CACHES.items():
        if owner != name:
            clear()
    give_back()


def in_stage(name: str) -> Callable:
    """A stage's map over batches: what other operators kept in the worker goes first, and what the task no longer
    uses goes back to the system at its end, where the worker may idle beside the JVM's shuffles."""

    def wrapped(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
        @functools.wraps(run)
        def task(batches: Iterator) -> Iterator:
            stage_begins(name)
            try:
                yield from run(batches)
            finally:
                give_back(collect=False)

        return task

    return wrapped


def give_back(collect: bool = True) -> None:
    """Return memory that the allocators hold but no object uses."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_order_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, chosen by the hash of ``key`` so that the choice is the same at every run.

    Only for fitting a classifier; ``rows`` is the documented bound.
    """
    return df.orderBy(F.xxhash64(F.lit("sample"), F.col(key)), F.col(key)).limit(rows)


def join_small_by_key(df: DataFrame, small: DataFrame, key: str, row_key: Column, max_rows: int, salts: int = 64) -> DataFrame:
    """``df`` left-joined to ``small`` (at most one row per ``key``, null a key like any other).

    ``small`` is counted first.  Up to ``max_rows`` it is broadcast and ``df`` is not shuffled;
    beyond that both sides are shuffled on (key, salt), so one key that holds a third of ``df``
    is spread over ``salts`` tasks.
    """
    right = small.withColumnRenamed(key, "_jk")
    if small.count() <= max_rows:
        return df.join(F.broadcast(right), df[key].eqNullSafe(right["_jk"]), "left").drop("_jk")
    left = df.withColumn("_salt", F.pmod(F.xxhash64(row_key), F.lit(salts)))
    right = right.withColumn("_rs", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    on = left[key].eqNullSafe(right["_jk"]) & (left["_salt"] == right["_rs"])
    return left.join(right, on, "left").drop("_jk", "_rs", "_salt")


def row_lists(batches: Iterator, text: str = "text") -> Iterator[tuple[list, list]]:
    """(ids, texts) of each Arrow batch with columns ``doc_id`` and ``text``; texts are ``str`` or None."""
    for b in batches:
        yield b.column("doc_id"), b.column(text).to_pylist()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
