"""Approximate nearest neighbours over balanced posting lists.

Fit, on a bounded sample: recursive halving at the median between two means gives lists of equal size on
the sample; the lists' centroids become the nodes of an in-memory graph (nearest centroids, neighbours in
the halving order, a few far links) that a beam search walks.  The pruning ratio is calibrated on sample
rows that took no part in the halving: the least ratio by which ``TARGET`` of their true neighbours lie in
a list whose centroid is at most that much farther than the nearest one.

Index: every vector goes to its nearest list, and a vector near a boundary also to up to ``REPLICAS`` - 1
further lists within ``BOUNDARY`` of the nearest distance.  Search: a query takes the lists within the calibrated ratio.  A vector that several of its lists
offer is scored in the first of them only, so nothing is found twice and repeated rows stay rows.

Scale: lists are cut into parts of ``PART_ROWS`` vectors and their queries into blocks of ``QUERY_ROWS``, by
exact counts, so a list that holds a third of all rows is many tasks; a list that no query takes is not
shuffled.  Per query at most k rows leave a part.  The driver holds the sample and at most
``FIT_ROWS / 8`` centroids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.common import hash_order_sample, materialize
from pairforge.llm.topk import usable

FIT_ROWS, LIST_ROWS, TARGET, BOUNDARY, REPLICAS, LINKS = 16384, 256, 0.99, 1.02, 3, 16
PART_ROWS, QUERY_ROWS, BEAM, BATCH = 8192, 1024, 32, 512


def taking_part(embedding: Column) -> Column:
    return usable(embedding) & F.exists(embedding, lambda x: x != 0)


def matrix(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows as doubles, shorter ones filled with 0 up to the longest (or ``width``)."""
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(flat), max(width, int(lengths.max(initial=0)))))
    values = flat.flatten().to_numpy(zero_copy_only=False)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(flat)), lengths), at] = values
    return out


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y (up to rounding)."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T), 0)


def halved(x: np.ndarray, lists: int, rounds: int = 4) -> list[np.ndarray]:
    """``lists`` groups of row numbers, equal in size up to rounding, neighbours in order."""
    todo, out = [(np.arange(len(x)), lists)], []
    while todo:
        rows, k = todo.pop()
        if k == 1:
            out.append(rows)
            continue
        some, left = x[rows], k // 2
        far = some[np.argmax(squares(some.mean(0)[None], some)[0])]
        a, b = far, some[np.argmax(squares(far[None], some)[0])]
        cut = round(len(rows) * left / k)
        for _ in range(rounds):
            order = np.argsort(some @ (b - a), kind="stable")
            a, b = some[order[:cut]].mean(0), some[order[cut:]].mean(0)
        todo += [(rows[order[cut:]], k - left), (rows[order[:cut]], left)]
    return out


@dataclass
class Lists:
    """Centroids, the graph over them and the pruning ratio."""

    centroids: np.ndarray
    edges: np.ndarray
    entry: int
    ratio: float

    def nearest(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(lists, squared distances) of the ``beam`` nearest centroids the graph search meets, by distance."""
        c = widened(self.centroids, x.shape[1])
        x = widened(x, c.shape[1])
        beam, norm, own = min(beam, len(c)), (c * c).sum(1), (x * x).sum(1)
        ids = np.full((len(x), beam), -1)
        dist = np.full((len(x), beam), np.inf)
        done = np.zeros((len(x), beam), bool)
        ids[:, 0], dist[:, 0] = self.entry, own + norm[self.entry] - 2 * (x @ c[self.entry])
        rows = np.arange(len(x))
        while len(rows):
            open_ = np.where(done[rows] | (ids[rows] < 0), np.inf, dist[rows])
            j = open_.argmin(1)
            going = np.isfinite(open_[np.arange(len(rows)), j])
            rows, j = rows[going], j[going]
            if not len(rows):
                break
            done[rows, j] = True
            near = self.edges[ids[rows, j]]
            d = own[rows][:, None] + norm[near] - 2 * np.einsum("rd,rmd->rm", x[rows], c[near])
            d[(near[:, :, None] == ids[rows][:, None, :]).any(2)] = np.inf
            all_ids, all_d = np.concatenate([ids[rows], near], 1), np.concatenate([dist[rows], d], 1)
            all_done = np.concatenate([done[rows], np.zeros(near.shape, bool)], 1)
            order = np.argsort(all_d, 1, kind="stable")[:, :beam]
            pick = np.arange(len(rows))[:, None]
            ids[rows], dist[rows], done[rows] = all_ids[pick, order], all_d[pick, order], all_done[pick, order]
            ids[rows] = np.where(np.isinf(dist[rows]), -1, ids[rows])
        return ids, np.maximum(dist, 0)

    def assign(self, x: np.ndarray, boundary: float = BOUNDARY, replicas: int = REPLICAS) -> np.ndarray:
        """Each row's lists, nearest first, -1 where there are fewer."""
        ids, d = self.nearest(x, BEAM)
        out = np.full((len(x), replicas), -1)
        out[:, 0] = ids[:, 0]
        used = np.ones(len(x), np.int64)
        for j in range(1, ids.shape[1]):
            new = ids[:, j]
            ok = (new >= 0) & (used < replicas) & (d[:, j] <= boundary**2 * d[:, 0])
            at = np.flatnonzero(ok)
            out[at, used[at]] = new[at]
            used[at] += 1
        return out

    def select(self, x: np.ndarray) -> np.ndarray:
        """Rows x lists: which lists a query takes; the beam widens until it reaches past the ratio."""
        out = np.zeros((len(x), len(self.centroids)), bool)
        rows, beam = np.arange(len(x)), 2 * BEAM
        while len(rows):
            ids, d = self.nearest(x[rows], beam)
            keep = (ids >= 0) & (d <= self.ratio**2 * d[:, :1] + 1e-12)
            at, j = np.nonzero(keep)
            out[rows[at], ids[at, j]] = True
            rows, beam = rows[keep[:, -1]] if beam < len(self.centroids) else rows[:0], beam * 4
        return out


def linked(centroids: np.ndarray, links: int = LINKS) -> tuple[np.ndarray, int]:
    """(edges, entry): nearest centroids, both neighbours in the halving order (so the graph is
    connected) and two far ones; a row is filled up with its own number."""
    k, rng = len(centroids), np.random.default_rng(0)
    far = [rng.permutation(k) for _ in range(2)]
    edges = np.empty((k, links + 4), np.int64)
    for at in range(0, k, 1024):
        d = squares(centroids[at : at + 1024], centroids)
        near = np.argsort(d, 1, kind="stable")[:, : links + 1]
        for i, row in enumerate(near, at):
            own = list(dict.fromkeys([*row.tolist(), max(i - 1, 0), min(i + 1, k - 1), *(int(f[i]) for f in far)]))
            own = [e for e in own if e != i][: links + 4]
            edges[i] = own + [i] * (links + 4 - len(own))
    return edges, int(np.argmin(squares(centroids.mean(0)[None], centroids)[0]))


def fit(vectors: DataFrame, *, k: int = 10, fit_rows: int = FIT_ROWS, list_rows: int = LIST_ROWS, target: float = TARGET) -> Lists | None:
    """Lists over a sample of at most ``fit_rows`` rows, chosen by the hash of vec_id; None without rows.
    There is one list for about ``list_rows`` vectors, but at least 8 sample rows a list."""
    n = vectors.count()
    sample = matrix(hash_order_sample(vectors.select("vec_id", "embedding"), "vec_id", fit_rows).select("embedding").toArrow().column("embedding"))
    if not len(sample):
        return None
    held, rest = sample[: len(sample) // 4], sample[len(sample) // 4 :]
    centroids = np.stack([rest[g].mean(0) for g in halved(rest, max(1, min(math.ceil(n / list_rows), len(rest) // 8)))])
    edges, entry = linked(centroids)
    lists = Lists(centroids, edges, entry, math.inf)
    asked = held[:512]
    if len(held) > k and len(centroids) > 1:
        d = squares(asked, held)
        d[np.arange(len(asked)), np.arange(len(asked))] = np.inf
        near = np.argpartition(d, k - 1, 1)[:, :k]
        to = np.sqrt(squares(asked, centroids))
        homes = lists.assign(held)[near]
        reach = np.where(homes >= 0, np.take_along_axis(to[:, None, :], np.maximum(homes, 0), 2), np.inf).min(2)
        lists.ratio = float(np.quantile(reach / np.maximum(to.min(1)[:, None], 1e-300), target))
    return lists


def _assigning(lists: Lists):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                some = b.slice(at, BATCH)
                homes = lists.assign(matrix(some.column("embedding")))
                own = pa.array([[int(x) for x in r if x >= 0] for r in homes], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*some.columns, own], names=[*some.schema.names, "lists"])

    return run


def _selecting(lists: Lists, everything: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                some = b.slice(at, BATCH)
                took = np.ones((some.num_rows, len(lists.centroids)), bool) if everything else lists.select(matrix(some.column("query")))
                bits = pa.array([np.packbits(r).tobytes() for r in took], pa.binary())
                own = pa.array([np.flatnonzero(r).tolist() for r in took], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*some.columns, own, bits], names=[*some.schema.names, "lists", "bits"])

    return run


def nearest_rows(q: np.ndarray, query_id: int, vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k nearest allowed rows; the expanded form only sieves, with room for its
    rounding, and the distances come from the differences."""
    at = np.flatnonzero(allowed & (ids != query_id))
    if len(at) > k:
        own = q @ q
        rough = norms[at] + own - 2 * (vectors[at] @ q)
        if np.isfinite(rough).all():
            limit = np.partition(rough, k - 1)[k - 1] + 1e-11 * (norms[at].max() + own)
            at = at[rough <= limit]
    gap = vectors[at] - q
    d = np.sqrt((gap * gap).sum(1))
    order = np.lexsort((ids[at], d))[:k]
    return ids[at[order]], d[order]


def _search_lists(index: DataFrame, queries: DataFrame, lists: Lists, k: int, everything: bool, part_rows: int, query_rows: int) -> DataFrame:
    taken = materialize(queries.mapInArrow(_selecting(lists, everything), f"query_id bigint, _qh bigint, query {queries.schema['query'].dataType.simpleString()}, lists array<int>, bits binary"), "ann-queries")
    n_lists = len(lists.centroids)

    def sizes(df: DataFrame, rows: int) -> Column:
        """Parts of each list: one row a list comes to the driver."""
        out = [0] * n_lists
        for i, n in df.select(F.explode("lists").alias("l")).groupBy("l").count().collect():
            out[i] = math.ceil(n / rows)
        return F.lit(out)

    parts, blocks = sizes(index, part_rows), sizes(taken, query_rows)
    each = lambda counts: F.explode(F.sequence(F.lit(0), F.get(counts, F.col("list")) - 1))
    both = lambda df: df.withColumn("list", F.explode("lists")).filter((F.get(parts, F.col("list")) > 0) & (F.get(blocks, F.col("list")) > 0))
    left = both(index).withColumn("part", F.pmod(F.xxhash64("vec_id", "embedding"), F.get(parts, F.col("list"))).cast("int")).withColumn("block", each(blocks))
    right = both(taken).drop("lists").withColumn("block", F.pmod(F.xxhash64("query_id", "_qh"), F.get(blocks, F.col("list"))).cast("int")).withColumn("part", each(parts))

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        out_q, out_h, out_v, out_s = [], [], [], []
        if a.num_rows and b.num_rows:
            here, ids = a.column("list")[0].as_py(), a.column("vec_id").to_numpy()
            v, q = matrix(a.column("embedding")), matrix(b.column("query"))
            v, q = widened(v, q.shape[1]), widened(q, v.shape[1])
            homes, norms = matrix(a.column("lists")).astype(np.int64), (v * v).sum(1)
            lengths = pc.list_value_length(a.column("lists")).to_numpy()
            homes[np.arange(homes.shape[1])[None, :] >= lengths[:, None]] = n_lists
            for row, query_id, h, bits in zip(q, b.column("query_id").to_pylist(), b.column("_qh").to_pylist(), b.column("bits").to_pylist(), strict=True):
                took = np.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=n_lists).astype(bool), False)
                first = took[homes].argmax(1)
                got, d = nearest_rows(row, query_id, v, norms, ids, homes[np.arange(len(homes)), first] == here, k)
                out_q += [query_id] * len(got)
                out_h += [h] * len(got)
                out_v += got.tolist()
                out_s += d.tolist()
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "_qh": pa.array(out_h, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})

    best = left.groupBy("list", "part", "block").cogroup(right.groupBy("list", "part", "block")).applyInArrow(tile, "query_id bigint, _qh bigint, vec_id bigint, score double")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "_qh").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, lists: Lists, k: int = 10, *, part_rows: int = PART_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k nearest rows found and their
    Euclidean distance, nearest first, ties to the smaller vec_id.

    Both inputs have vec_id and embedding; all rows must be ``taking_part``.  A query never meets rows of
    its own id; repeated rows of one id are candidates each; equal query rows count once.  Rows without
    an id take no part.  Vectors of unequal length are filled with 0.  A query that finds fewer than k
    rows in its lists (say, because they are full of its own id) is asked again over all lists.
    """
    same = vectors.schema["embedding"].dataType.simpleString()
    index = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull())
    index = materialize(index.mapInArrow(_assigning(lists), f"vec_id bigint, embedding {same}, lists array<int>"), "ann-index")
    asked = queries.select(F.col("vec_id").cast("bigint").alias("query_id"), F.xxhash64("embedding").alias("_qh"), F.col("embedding").alias("query")).filter(F.col("query_id").isNotNull()).dropDuplicates(["query_id", "query"])
    found = materialize(_search_lists(index, asked, lists, k, False, part_rows, query_rows), "ann-found")
    enough = found.groupBy("query_id", "_qh").count().filter(F.col("count") >= k)
    short = materialize(asked.join(enough, ["query_id", "_qh"], "left_anti").select(*asked.columns), "ann-short")
    if not short.isEmpty():
        again = _search_lists(index, short, lists, k, True, part_rows, query_rows)
        found = found.join(short.select("query_id", "_qh"), ["query_id", "_qh"], "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")


def search_table(embeddings: DataFrame, *, every: int = 100, k: int = 10, **bounds: float) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by ``every``, candidates all rows.  Vectors that are
    null or zero (an empty one is zero) or hold null or non-finite components take no part.  Without
    vectors the result is empty."""
    rows = embeddings.filter(taking_part(F.col("embedding"))).filter(F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    lists = fit(rows, k=k, **bounds)
    if lists is None:
        return embeddings.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return search(rows, rows.filter(F.col("vec_id") % every == 0), lists, k)
