"""Regroup flat per-sample rows into an ordered list per key.

The reference rebuilds ``outputs[i * num_samples + j]`` by position.  Here the order comes
from the explicit sample index, never from arrival order, so the result does not depend on
partitioning.  Groups hold ``num_samples`` rows, so collecting per key is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regroup_ordered(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    out: str,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """``groupBy(key)`` → ``out`` = values sorted by ``order`` (plus any extra aggregates)."""
    aggs = [F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("__pairs")]
    for name, expr in (extra or {}).items():
        aggs.append(expr.alias(name))
    grouped = df.groupBy(key).agg(*aggs)
    return grouped.withColumn(out, F.transform("__pairs", lambda p: p["v"])).drop("__pairs")
