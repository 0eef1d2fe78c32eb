"""A sized Bloom sketch of texts as a prefilter for anti-joins.

Spark's own runtime Bloom filters serve inner and semi joins; an anti-join keeps exactly the rows such a
filter would drop.  ``exclude_prefiltered`` therefore splits the rows by the sketch: a row whose text is
certainly not among the used ones passes through without moving, and only the rest meets the used texts in
the exact anti-join.  The result is the same with any sketch; only the number of shuffled rows depends on it.

The sketch is a bit array of a power of two, ``BITS_PER_ITEM`` bits a used text and at most ``MOST_BITS``
(2 MB).  It is built by partial aggregation (words of 64 bits, combined by ``bit_or``) and reaches the tasks
as one scalar subquery.  The used side is counted first: past the size where half of all lookups would hit
by chance, the plain anti-join is the better plan and is taken.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ITEM, PROBES, MOST_BITS, LEAST_BITS, LITERAL_BITS = 10, 4, 24, 10, 17


@dataclass(frozen=True)
class Sketch:
    """``bits``: the array column (a scalar subquery), of ``2 ** log_bits`` bits; ``chance``: the expected
    share of texts that hit although they were never added."""

    bits: Column
    log_bits: int
    chance: float


def _places(text: Column, log_bits: int) -> list[Column]:
    """The probes' bit numbers: two hashes, stepped."""
    first, step = F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text).bitwiseOR(F.lit(1))
    mask = F.lit((1 << log_bits) - 1)
    return [(F.shiftrightunsigned(first, 7).bitwiseAND(F.lit((1 << 40) - 1)) + F.shiftrightunsigned(step, 24) * F.lit(i)).bitwiseAND(mask) for i in range(PROBES)]


def size_of(items: int, most_bits: int = MOST_BITS) -> tuple[int, float]:
    """(log2 of the bits, expected chance hits) for so many distinct items."""
    log_bits = min(most_bits, max(LEAST_BITS, math.ceil(math.log2(max(1, items * BITS_PER_ITEM)))))
    return log_bits, (1 - math.exp(-PROBES * items / 2**log_bits)) ** PROBES


def _bit_array(at: DataFrame, log_bits: int) -> Column:
    """The bit numbers in column ``at`` as an array of 64-bit words, a scalar subquery."""
    words = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("m"))
    every = at.sparkSession.range(1 << (log_bits - 6)).withColumnRenamed("id", "w").join(words, "w", "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", F.coalesce("m", F.lit(0).cast("bigint")).alias("m")))), lambda x: x["m"]).alias("bits")).scalar()


def _test(bits: Column, at: Column) -> Column:
    word, shift = F.get(bits, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftrightunsigned", word, shift).bitwiseAND(F.lit(1)) == 1


def hash_bits(items: DataFrame, col: str, n: int, most_bits: int = LITERAL_BITS) -> Sketch:
    """A sketch of 64-bit hashes with one probe, about 32 bits an item (``n`` of them), for ``bit_set``.

    Its at most 2 ** (LITERAL_BITS - 6) words become a literal, since higher-order functions take no subquery.
    """
    log_bits = min(most_bits, max(LEAST_BITS, math.ceil(math.log2(max(1, 32 * n)))))
    at = items.filter(F.col(col).isNotNull()).select(F.col(col).bitwiseAND(F.lit((1 << log_bits) - 1)).alias("at"))
    words = [0] * (1 << (log_bits - 6))
    for w, m in at.groupBy(F.shiftright("at", 6)).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))"))).collect():
        words[w] = m
    return Sketch(F.lit(words).cast("array<bigint>"), log_bits, 1 - math.exp(-n / 2**log_bits))


def bit_set(sketch: Sketch, value: Column) -> Column:
    """False only for hashes that were certainly not added."""
    return _test(sketch.bits, value.bitwiseAND(F.lit((1 << sketch.log_bits) - 1)))


def build(items: DataFrame, col: str, n: int, most_bits: int = MOST_BITS) -> Sketch:
    """The sketch of ``items``' texts (``n`` of them); nulls are not added."""
    log_bits, chance = size_of(n, most_bits)
    at = items.filter(F.col(col).isNotNull()).select(F.explode(F.array(*_places(F.col(col), log_bits))).alias("at"))
    return Sketch(_bit_array(at, log_bits), log_bits, chance)


def may_contain(sketch: Sketch, text: Column) -> Column:
    """False only for texts that were certainly not added (a null text was not)."""
    hit = text.isNotNull()
    for at in _places(text, sketch.log_bits):
        hit = hit & _test(sketch.bits, at)
    return hit


def exclude_prefiltered(
    rows: DataFrame, used: DataFrame, col: str, exclude: Callable[[DataFrame, DataFrame], DataFrame], most_bits: int = MOST_BITS
) -> DataFrame:
    """``exclude(rows, used)``, but only over the rows whose text may be among the used ones.

    ``exclude`` must treat rows one by one (an anti-join does).  ``rows`` is read twice, so write a dear
    one first.  Nothing used, nothing excluded.
    """
    n = used.count()
    if n == 0:
        return rows
    _, chance = size_of(n, most_bits)
    if chance > 0.5:
        return exclude(rows, used)
    hit = may_contain(build(used, col, n, most_bits), F.col(col))
    return rows.filter(~hit).unionByName(exclude(rows.filter(hit), used))
