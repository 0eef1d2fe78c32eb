"""Splits, seeded shuffles, head/offset.

Every random choice is a pure function of ``(seed, row key)`` through ``md5``, so results do
not depend on partitioning, task retries or arrival order (SURVEY §7.5.3), and the same
hashes are available in DuckDB for the oracle.

* ``split_exact`` (L3): the ``ceil(f * n)`` rows with the smallest ``md5(seed:key)`` are
  test.  The cut comes from radix histograms of the hashes (``selection``): the rows are not
  sorted, exchanged or written, and ``randomSplit`` (inexact and partitioning-dependent) is not used.
* ``split_bucket`` (L3b): stable hash bucket; one narrow pass, streamable, membership never
  changes when rows arrive.
* ``shuffle_positions`` (L4): seeded permutation as dense positions.  ``shuffle_take`` finds
  the cut after ``n`` rows by histograms, filters, and numbers only those ``n`` rows; asking for
  more rows than exist raises, like the reference's ``select(range(n))``.
* ``head`` / ``head_offset`` (L1/L2): on dense positions these are range filters that reach
  the Parquet scan, not sorts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge.operators.positional import dense_index
from pairforge.operators.selection import mark_smallest

BUCKETS = 10000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def seeded_hash(key, seed: int | str, salt: str = "") -> Column:
    """Lower-case hex ``md5("{salt}{seed}:{key}")`` (same bytes in Spark and DuckDB)."""
    return F.md5(F.concat(F.lit(f"{salt}{seed}:"), _c(key).cast("string")))


def hash_bucket(key, seed: int | str, salt: str = "", buckets: int = BUCKETS) -> Column:
    """First 32 bits of the seeded md5 as an integer, modulo ``buckets``."""
    h = seeded_hash(key, seed, salt)
    return F.pmod(F.conv(F.substr(h, F.lit(1), F.lit(8)), 16, 10).cast("bigint"), F.lit(buckets))


def split_exact(
    df: DataFrame, key: str, fraction: float = C.SPLIT_FRACTION, seed: int = C.SPLIT_SEED,
    split_col: str = "split", salt: str = "", keys: DataFrame | None = None,
) -> DataFrame:
    """L3: exact-size seeded split; ``ceil(fraction * n)`` rows are ``test``.

    ``keys``: a written table with the same ``key`` column, counted in place of a dear ``df``.
    """
    if not 0.0 <= fraction < 1.0:
        raise ValueError("fraction must be in [0, 1)")
    marked, _ = mark_smallest(df, seeded_hash(key, seed, salt), key, lambda n: ceil_test_size(n, fraction), "__test", keys)
    return marked.withColumn(split_col, F.when(F.col("__test"), "test").otherwise("train")).drop("__test")


def split_bucket(
    df: DataFrame, key: str, fraction: float = C.SPLIT_FRACTION, seed: int = C.SPLIT_SEED,
    split_col: str = "split", salt: str = "",
) -> DataFrame:
    """Stable hash-bucket split (approximate size, one narrow pass)."""
    cut = int(round(fraction * BUCKETS))
    return df.withColumn(split_col, F.when(hash_bucket(key, seed, salt) < cut, "test").otherwise("train"))


def train_eval(df: DataFrame, key: str, fraction: float, seed: int) -> tuple[DataFrame, DataFrame | None]:
    """No split when the fraction is 0 (eval side is ``None``)."""
    if fraction <= 0:
        return df, None
    s = split_exact(df, key, fraction, seed)
    return s.filter(F.col("split") == "train").drop("split"), s.filter(F.col("split") == "test").drop("split")


def shuffle_positions(df: DataFrame, key: str, seed: int = C.DEFAULT_SEED, pos_col: str = "position", salt: str = "shuffle:") -> DataFrame:
    """L4 (whole permutation): dense 0-based position in seeded-hash order."""
    return dense_index(df.withColumn("__h", seeded_hash(key, seed, salt)), ["__h", key], id_col=pos_col).drop("__h")


def shuffle_take(df: DataFrame, key: str, n: int, seed: int = C.DEFAULT_SEED, pos_col: str = "position", salt: str = "shuffle:") -> DataFrame:
    """L4: seeded shuffle then take ``n``; more than available raises, as the reference does."""
    marked, size = mark_smallest(df, seeded_hash(key, seed, salt), key, lambda _: n, "__taken")
    if size < n:
        raise ValueError(f"shuffle_take: requested {n} rows, {size} available")
    return shuffle_positions(marked.filter(F.col("__taken")).drop("__taken"), key, seed, pos_col, salt)


def head(df: DataFrame, position: str, n: int | None) -> DataFrame:
    """L1: first ``n`` rows by position, clamped to the size (``None`` = all)."""
    return df if n is None else df.filter(F.col(position) < F.lit(n))


def head_offset(df: DataFrame, position: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """L2: skip ``offset`` rows then keep ``limit`` (negative values rejected, Q18)."""
    if offset < 0 or (limit is not None and limit < 0):
        raise ValueError("offset and limit must be non-negative")
    out = df.filter(F.col(position) >= F.lit(offset)) if offset else df
    return out if limit is None else out.filter(F.col(position) < F.lit(offset + limit))


def ceil_test_size(n: int, fraction: float) -> int:
    return int(math.ceil(fraction * n))
