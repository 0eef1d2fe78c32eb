"""Positional operators: dense 0-based ids over an ordering (N1) and batch plans.

``row_number() OVER (ORDER BY ...)`` without a partition runs in a single task, which does
not survive 100 TB.  ``dense_index`` does what ``zipWithIndex`` does, in DataFrame form:

1. range-partition on the ordering keys and sort within partitions (one shuffle; AQE may
   merge adjacent small ranges);
2. tag each row with its partition id and its ordinal inside the partition, and write the
   tagged rows once as a table in the shared checkpoint folder, so the sampled range bounds
   and the tags cannot change if an executor is lost and a stage is recomputed;
3. count rows per partition (a result bounded by the partition count, not the data);
4. add each partition's prefix offset, shipped as one array literal.

The final step is a narrow projection: no second shuffle, no window, no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.session import materialize

_PID = "__pf_pid"
_ORD = "__pf_ord"
# monotonically_increasing_id() puts the partition index in the upper 31 bits.
_ORD_BITS = 33


def dense_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    id_col: str = "row_id",
    num_partitions: int | None = None,
) -> DataFrame:
    """Append ``id_col`` = 0-based position of each row in the total order ``order_by``.

    The ordering must be total (unique keys) for the ids to be reproducible; ties are
    broken by the physical order of the written data, which is fixed once written.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order_by]
    # Without an explicit count AQE may coalesce neighbouring ranges to its advisory size;
    # coalescing is contiguous, so partition index order still follows key order.
    ranged = df.repartitionByRange(int(num_partitions), *keys) if num_partitions else df.repartitionByRange(*keys)
    tagged = materialize(
        ranged
        .sortWithinPartitions(*keys)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_ORD, F.monotonically_increasing_id()),
        "dense_index",
    )
    # Bounded by the number of partitions: safe to bring to the driver.
    counts = {r[0]: r[1] for r in tagged.groupBy(_PID).count().collect()}
    offsets, running = [], 0
    for pid in range(max(counts, default=-1) + 1):
        offsets.append(running)
        running += counts.get(pid, 0)
    if not offsets:
        offsets = [0]
    offset = F.get(F.lit(offsets), F.col(_PID))
    within = F.col(_ORD) - F.shiftleft(F.col(_PID).cast("long"), _ORD_BITS)
    return tagged.withColumn(id_col, offset + within).drop(_PID, _ORD)


def batch_ids(position: str | Column, batch_size: int) -> Column:
    """Fixed-size batches in input order; the last one may be short."""
    pos = F.col(position) if isinstance(position, str) else position
    return F.floor(pos / F.lit(batch_size)).cast("bigint")
