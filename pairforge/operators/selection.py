"""Exact order statistics of a seeded hash by radix histograms (L3, L4).

Choosing the ``n`` rows with the smallest ``(hash, key)`` needs no sort of the rows.  One pass counts the
rows per prefix of ``DIGITS`` hex digits (partial aggregation, at most ``16 ** DIGITS`` counts reach the
driver); the prefix that holds rank ``n`` is refined by the next digits until few rows share it; their
distinct (hash, key) pairs give the cut.  The rows are then marked by one comparison with the cut, so the
final plan is a narrow projection: no exchange, no sort, no write, and only the key column is read for
counting.  10^11 rows take two histogram passes and one look at a few dozen keys.

Rows that share the cut's key are the one case that a comparison cannot divide.  Only if the rank falls
among them are those rows (and no others) numbered by their remaining columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.operators.positional import dense_index

DIGITS, HEX, FEW = 4, 32, 4096


@dataclass(frozen=True)
class Cut:
    """The (hash, key) at the wanted rank; ``take`` of the ``equal`` rows that have both belong to it."""

    hash: str
    key: Any
    take: int
    equal: int


def _total_hash(h: Column) -> Column:
    """Null keys have a null hash; they come first, as in an ascending sort."""
    return F.coalesce(h, F.lit(""))


def find_cut(keys: DataFrame, h: Column, key: str, wanted: Callable[[int], int], digits: int = DIGITS, few: int = FEW) -> tuple[Cut | None, int]:
    """(cut after the ``wanted(total)`` smallest (hash, key) rows, total); no cut if nothing or
    everything is wanted.  ``h`` is a 32-digit lower-case hex hash of ``key``."""
    rows = keys.select(_total_hash(h).alias("h"), F.col(key).alias("k"))
    prefix, rank, total, depth = "", 0, None, 0
    while depth < HEX:
        part = rows.filter(F.substring("h", 1, depth) == prefix) if depth else rows
        counts = sorted((r["p"], r["n"]) for r in part.groupBy(F.substring("h", 1, depth + digits).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        if total is None:
            total = sum(n for _, n in counts)
            rank = wanted(total)
            if rank <= 0 or rank >= total:
                return None, total
        for prefix, n in counts:
            if rank <= n:
                break
            rank -= n
        depth += digits
        if n <= few or len(prefix) < depth:
            break
    # At most ``few`` rows share the prefix, or they share the whole hash and so the key.
    same = rows.filter(F.substring("h", 1, depth) == prefix).groupBy("h", "k").agg(F.count(F.lit(1)).alias("n")).orderBy("h", "k")
    for r in same.collect():
        if rank <= r["n"]:
            return Cut(r["h"], r["k"], rank, r["n"]), total
        rank -= r["n"]
    raise RuntimeError("the rows changed between two passes: write them once before selecting from them")


def _at_cut(h: Column, key: str, cut: Cut) -> Column:
    return (_total_hash(h) == cut.hash) & F.col(key).eqNullSafe(F.lit(cut.key))


def _before_cut(h: Column, key: str, cut: Cut) -> Column:
    below = _total_hash(h) < cut.hash
    return below if cut.key is None else below | ((_total_hash(h) == cut.hash) & F.coalesce(F.col(key) < F.lit(cut.key), F.lit(False)))


def mark_smallest(df: DataFrame, h: Column, key: str, wanted: Callable[[int], int], flag: str, keys: DataFrame | None = None) -> tuple[DataFrame, int]:
    """(``df`` with boolean ``flag``, total): true on exactly ``wanted(total)`` rows, those with the smallest
    (hash, key).

    ``keys`` is a table of the same keys to count instead of ``df``, for a ``df`` that is dear to compute.
    Null keys come first.  Rows with the same key as the cut are divided by the order of their other
    orderable columns; equal rows are interchangeable.  An empty ``df`` stays empty.
    """
    cut, total = find_cut(df if keys is None else keys, h, key, wanted)
    if cut is None:
        return df.withColumn(flag, F.lit(wanted(total) > 0)), total
    before, at = _before_cut(h, key, cut), _at_cut(h, key, cut)
    if cut.take == cut.equal:
        return df.withColumn(flag, before | at), total
    others = [c.name for c in df.schema if c.name != key and not isinstance(c.dataType, (T.MapType, T.VariantType))]
    tied = dense_index(df.filter(at), [key, *others], id_col="__tie")
    tied = tied.withColumn(flag, F.col("__tie") < cut.take).drop("__tie")
    return df.filter(~at).withColumn(flag, before).unionByName(tied), total
