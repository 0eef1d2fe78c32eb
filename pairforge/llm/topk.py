"""Exact top-k search by MaxScore over signed integer postings.

A query's terms are the dimensions where it is not 0.  Within a shard a term's bound is the most
it can add to any vector's score.  Terms in descending order of bound are essential until the rest
together cannot lift a vector to the k-th best score found so far; their postings are traversed for
a block of vectors at once, and the non-essential terms are probed, bound by bound, only for vectors
that are still competitive.  The shards' best k are merged.

Scale: shards and query blocks of bounded size meet in (shards x blocks) tasks; each side is
replicated only by the number of blocks of the other.  Per query at most k rows leave a shard.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, QUERY_ROWS, BLOCK, PROBE = 8192, 4096, 1024, 8
EXACT = float(2**53)


def quantised(embedding: Column, scale: float = 1024.0) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))


def usable(embedding: Column) -> Column:
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of unequal length are filled with 0."""
    flat = column.combine_chunks()
    out = np.zeros((len(flat), width), dtype=np.int64)
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks) if flat.num_chunks else pa.array([], column.type)
    lengths = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(flat)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def shard_topk(query: np.ndarray, query_id: int, vectors: np.ndarray, ids: np.ndarray, top: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the shard's best k for one query.  ``vectors`` is dimension-major; ``top`` and
    ``low`` are the largest and smallest component in each dimension."""
    bound = np.maximum(np.maximum(query * top, query * low), 0)  # a term that only lowers scores has bound 0
    order = np.argsort(-bound, kind="stable")
    order = order[query[order] != 0]
    rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])  # rest[j]: what terms j, j+1, ... can add
    best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=vectors.dtype)
    for at in range(0, vectors.shape[1], BLOCK):
        part = vectors[:, at : at + BLOCK]
        least = best[-1] if len(best) == k else -math.inf
        essential = int(np.searchsorted(-rest, -least, side="right")) if least > -math.inf else len(order)
        essential = min(essential, len(order))
        score = query[order[:essential]] @ part[order[:essential]]
        alive = np.arange(part.shape[1])
        j = essential
        while j < len(order):
            stay = score + rest[j] >= least
            alive, score = alive[stay], score[stay]
            if not len(alive):
                break
            more = order[j : j + PROBE]
            score = score + query[more] @ part[np.ix_(more, alive)]
            j += PROBE
        stay = (score >= least) & (ids[at + alive] != query_id)
        best_ids, best = np.concatenate([best_ids, ids[at + alive[stay]]]), np.concatenate([best, score[stay]])
        keep = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[keep], best[keep]
    return best_ids, best


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, *, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products.

    Both inputs have ``vec_id`` and ``q`` (array of bigint, no nulls).  A query never meets rows of
    its own id.  Ties go to the smaller vec_id; repeated rows of one id are candidates each; equal
    query rows count once.  Rows with a null id take no part.  Vectors of unequal length are filled
    with 0.  Scores must fit a long.  Without queries or candidates the result is empty.
    """
    vectors = vectors.select("vec_id", "q").filter(F.col("vec_id").isNotNull())
    queries = queries.select(F.col("vec_id").alias("query_id"), F.col("q").alias("qq")).filter(F.col("query_id").isNotNull()).dropDuplicates()
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("d")).first()
    shards = max(1, math.ceil(size["n"] / shard_rows))
    blocks = max(1, math.ceil(queries.count() / query_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.withColumn("_shard", F.pmod(F.xxhash64("vec_id", "q"), F.lit(shards)).cast("int")).withColumn("_block", every(blocks))
    right = queries.withColumn("_block", F.pmod(F.xxhash64("query_id", "qq"), F.lit(blocks)).cast("int")).withColumn("_shard", every(shards))

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        out_q, out_h, out_v, out_s = [], [], [], []
        if a.num_rows and b.num_rows:
            width = max(pc.max(pc.list_value_length(c)).as_py() or 0 for c in (a.column("q"), b.column("qq")))
            ids = a.column("vec_id").to_numpy()
            v, q = _matrix(a.column("q"), width), _matrix(b.column("qq"), width)
            most = float(np.abs(v).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(width, 1)
            kind = np.float64 if most < EXACT else np.int64  # either is exact; the first is faster
            v, q = np.ascontiguousarray(v.T.astype(kind)), q.astype(kind)
            top, low = v.max(1), v.min(1)
            for row, query_id, h in zip(q, b.column("query_id").to_pylist(), b.column("_qh").to_pylist(), strict=True):
                got, score = shard_topk(row, query_id, v, ids, top, low, k)
                out_q += [query_id] * len(got)
                out_h += [h] * len(got)
                out_v += got.tolist()
                out_s += [int(x) for x in score]
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "_qh": pa.array(out_h, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.int64())})

    right = right.withColumn("_qh", F.xxhash64("qq"))
    best = left.groupBy("_shard", "_block").cogroup(right.groupBy("_shard", "_block")).applyInArrow(tile, "query_id bigint, _qh bigint, vec_id bigint, score bigint")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "_qh").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_table(embeddings: DataFrame, *, every: int = 100, k: int = 10) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by ``every``, candidates all rows; components
    are floor(1024 * x).  Null vectors and vectors that hold null or non-finite components take no part."""
    rows = embeddings.filter(usable(F.col("embedding"))).select("vec_id", quantised(F.col("embedding")).alias("q"))
    return search(rows, rows.filter(F.col("vec_id") % every == 0), k)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
