"""Conversation prefix trie with subtree totals by time-forward processing.

Every distinct sequence of first d turns is a node.  Its key is a digest chained over the turns, so
equal sequences get equal keys in any task; only digests and word counts of the turns are shuffled.

Totals go up the tree: nodes stand in reverse level order (deepest first, then by key), each node
takes the messages addressed to it from a priority queue kept in the same order, adds its own share
and sends its total to its parent.  The queue spills, so a task holds a bounded number of messages
however large its part of the tree is.

Shards: a node's weight is the number of turns its members have from it on, an upper bound of its
subtree's nodes.  Nodes over ``max(SHARD_NODES, sqrt(turns))`` are the top of the tree; what hangs
below them are whole subtrees under that weight, each swept in one task.  The totals of the shard
roots, summed by parent, are the messages of a last sweep over the top, which holds at most
depth x sqrt(turns) nodes.  A node that a third of all conversations share is one row by then.

Chains of very long conversations run in blocks of ``BLOCK`` turns that are linked afterwards, so no
task walks a whole conversation.  Digests keep 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import materialize
from pairforge.operators.positional import dense_index

SHARD_NODES, BLOCK, QUEUE, CHUNK_IDS = 256, 4096, 500_000, 8192
ROOT = bytes(16)
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256().hexdigest()

STEP = "conv_id bigint, depth bigint, length bigint, words bigint, block bigint, parent binary, local binary"
TOTALS = "shard binary, key binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def _link(a: Column, b: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(a, b), 256)), 1, 16)


def _digest(prev: bytes, more: bytes) -> bytes:
    return hashlib.sha256(prev + more).digest()[:16]


def _numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (dense over all conversations), digest, words of each turn; the texts stay behind."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(framed, 256)).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    return dense_index(turns, ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"], id_col="pos").select("conv_id", "pos", "digest", "words")


def _rebuilt(rows: DataFrame, group: int, shared: int) -> tuple[DataFrame, DataFrame]:
    """(per conversation: conv_id, h, k, start, length, first k turns of its base; per turn after the
    rebuilding: conv_id, depth, length, digest, words)."""
    convs = rows.groupBy("conv_id").agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("n"))
    placed = rows.join(convs.select("conv_id", "start"), "conv_id").withColumn("i", F.col("pos") - F.col("start"))
    heads = placed.filter(F.col("i") < shared - 1).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("i", "digest", "words"))).alias("head"))
    with_base = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", F.crc32(F.col("conv_id").cast("string")) % shared)
    meta = with_base.join(heads, "base", "left").withColumn("k", F.least("h", F.coalesce(F.size("head"), F.lit(0))))
    meta = meta.select(
        "conv_id", "h", "k", "start", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        F.slice(F.coalesce("head", F.array().cast("array<struct<i:bigint,digest:binary,words:bigint>>")), F.lit(1), F.col("k").cast("int")).alias("head"),
    )
    meta = materialize(meta, "trie-conversations")
    own = rows.join(meta.drop("head"), "conv_id").withColumn("i", F.col("pos") - F.col("start")).filter(F.col("i") >= F.col("h"))
    own = own.select("conv_id", (F.col("k") + F.col("i") - F.col("h") + 1).alias("depth"), "length", "digest", "words")
    base = meta.select("conv_id", "length", F.explode("head").alias("t")).select("conv_id", (F.col("t.i") + 1).alias("depth"), "length", "t.digest", "t.words")
    return meta, own.unionByName(base)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, block, depth): the digest chained within each block."""
    at, prev = None, b""
    for b in batches:
        parents, keys = [], []
        for conv, block, digest in zip(b.column("conv_id").to_pylist(), b.column("block").to_pylist(), b.column("digest").to_pylist(), strict=True):
            if (conv, block) != at:
                at, prev = (conv, block), b""
            parents.append(prev)
            prev = _digest(prev, digest)
            keys.append(prev)
        cols = [b.column(c) for c in ("conv_id", "depth", "length", "words", "block")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(parents, pa.binary()), pa.array(keys, pa.binary())], names=["conv_id", "depth", "length", "words", "block", "parent", "local"])


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends of whole blocks sorted by (conv_id, block): the key that the next block goes on from."""
    at, prev = None, b""
    for b in batches:
        conv_ids, keys = b.column("conv_id").to_pylist(), []
        for conv, local in zip(conv_ids, b.column("local").to_pylist(), strict=True):
            prev = _digest(prev, local) if conv == at else local
            at = conv
            keys.append(prev)
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array([x + 1 for x in b.column("block").to_pylist()], pa.int64()), pa.array(keys, pa.binary())], names=["conv_id", "block", "carry"])


def _steps(rebuilt: DataFrame, block: int) -> DataFrame:
    """conv_id, depth, length, words, key, parent: every conversation's path through the trie."""
    cut = rebuilt.withColumn("block", F.floor((F.col("depth") - 1) / block))
    local = materialize(cut.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "depth").mapInArrow(_chain, STEP), "trie-chains")
    ends = local.filter((F.col("depth") % block == 0) & (F.col("length") > F.col("depth"))).select("conv_id", "block", "local")
    carry = ends.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_carry, "conv_id bigint, block bigint, carry binary")
    whole = local.join(carry, ["conv_id", "block"], "left")
    first = F.when(F.octet_length("parent") == 0, F.coalesce("carry", F.lit(ROOT)))
    return whole.select(
        "conv_id", "depth", "length", "words",
        F.when(F.col("carry").isNull(), F.col("local")).otherwise(_link(F.col("carry"), F.col("local"))).alias("key"),
        first.when(F.col("carry").isNull(), F.col("parent")).otherwise(_link(F.col("carry"), F.col("parent"))).alias("parent"),
    )


class SpillingQueue:
    """A priority queue that holds at most ``limit`` items in memory; the later half of an overflow goes
    as a sorted run to an unnamed scratch file of the task, which the system frees with the task.
    Nothing outside the task reads it: a task that is lost starts again from its sorted input."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.heads, self.runs = max(2, limit), [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self.heap.sort()
            keep = self.limit // 2
            run = self._read(self._written(self.heap[keep:]))
            del self.heap[keep:]  # a sorted list is a heap
            self.runs += 1
            heapq.heappush(self.heads, (next(run), self.runs, run))

    @staticmethod
    def _written(items: list, step: int = 4096):
        f = tempfile.TemporaryFile()
        for at in range(0, len(items), step):
            pickle.dump(items[at : at + step], f)
        f.seek(0)
        return f

    @staticmethod
    def _read(f) -> Iterator[tuple]:
        with f:
            while True:
                try:
                    yield from pickle.load(f)
                except EOFError:
                    return

    def peek(self) -> tuple | None:
        tops = self.heap[:1] + [head[0] for head in self.heads[:1]]
        return min(tops) if tops else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, number, run = heapq.heappop(self.heads)
            if (following := next(run, None)) is not None:
                heapq.heappush(self.heads, (following, number, run))
            return item
        return heapq.heappop(self.heap)


def _sweep(limit: int):
    """Rows sorted by (shard, depth descending, key), with what earlier sweeps sent to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue = None, SpillingQueue(limit)
        for b in batches:
            c = {n: b.column(n).to_pylist() for n in b.schema.names}
            children, leaves, saved = [], [], []
            for s, key, parent, depth, n, words, n_in, l_in, s_in in zip(*(c[x] for x in ("shard", "key", "parent", "depth", "n_convs", "words", "in_children", "in_leaves", "in_saved")), strict=True):
                if s != shard:
                    if queue.peek() is not None:
                        raise RuntimeError("a message was left over: a parent is missing in its shard")
                    shard = s
                while (top := queue.peek()) is not None and top[:2] == (-depth, key):
                    _, _, more_leaves, more_saved = queue.pop()
                    n_in, l_in, s_in = n_in + 1, l_in + more_leaves, s_in + more_saved
                l_in, s_in = l_in if n_in else 1, s_in + (n - 1) * words
                children.append(n_in)
                leaves.append(l_in)
                saved.append(s_in)
                if parent is not None and key != s:
                    queue.push((1 - depth, parent, l_in, s_in))
            cols = [b.column(x) for x in ("shard", "key", "parent", "depth", "conv_id", "n_convs")]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(x, pa.int64()) for x in (children, leaves, saved))], names=["shard", "key", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"])

    return run


def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, conv_id): comma-joined runs of at most CHUNK_IDS ids."""
    names = ["key", "first", "ids"]

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1][0] for r in rows], pa.int64()), pa.array([",".join(map(str, r[1])) for r in rows], pa.string())], names=names)

    key, ids, done, held = None, [], [], 0
    for b in batches:
        for k, conv in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
            if ids and (k != key or len(ids) >= CHUNK_IDS):
                done.append((key, ids))
                held, ids = held + len(ids), []
                if held >= 4 * CHUNK_IDS:
                    yield out(done)
                    done, held = [], 0
            key = k
            ids.append(conv)
    if ids:
        done.append((key, ids))
    if done:
        yield out(done)


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by (key, first): SHA-256 of each key's joined runs, one state at a time."""
    key, state = None, None
    for b in batches:
        keys, shas = [], []
        for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if k == key:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                keys.append(key)
                shas.append(state.hexdigest())
            key, state = k, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], names=["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])


def build(conversations: DataFrame, *, group: int = 20, shared: int = 4, shard_nodes: int = SHARD_NODES, block: int = BLOCK, queue: int = QUEUE) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 of each node of the prefix trie over the rebuilt conversations.

    A conversation c starts with the first h = crc32(c) % ``shared`` turns of conversation c - c %
    ``group`` and goes on with its own turns after its first h.  Null roles and texts are empty ones; a
    null turn comes first; turns that tie are ordered by role, then by the digest of role and text, and
    repeated rows are turns each.  Rows without a conv_id belong to no conversation.  ``%`` keeps the sign
    of a negative id, as in SQL.  An empty table has no node, not even a root.  Other columns are ignored.
    """
    rows = _numbered(conversations)
    meta, rebuilt = _rebuilt(rows, group, shared)
    steps = materialize(_steps(rebuilt, block), "trie-steps")
    nodes = steps.groupBy("key").agg(
        F.any_value("parent").alias("parent"), F.any_value("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.any_value("words").alias("words"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    root = meta.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("length").alias("weight")).filter("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("bigint").alias("words"), "weight")
    nodes = materialize(nodes.unionByName(root), "trie-nodes")

    limit = max(shard_nodes, math.isqrt(steps.count()))
    top = (F.col("depth") == 0) | (F.col("weight") > limit)
    below = steps.join(nodes.filter(top).select("key"), "key", "left_anti")
    shards = below.groupBy("conv_id").agg(F.min_by("key", "depth").alias("shard"))
    nothing = [F.lit(0).cast("bigint").alias(c) for c in ("in_children", "in_leaves", "in_saved")]
    light = nodes.filter(~top).join(shards, "conv_id").select("*", *nothing)
    low = materialize(light.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "key").mapInArrow(_sweep(queue), TOTALS), "trie-shards")

    sent = low.filter(F.col("key") == F.col("shard")).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved"))
    heavy = nodes.filter(top).join(sent, "key", "left").fillna(0, ["in_children", "in_leaves", "in_saved"]).withColumn("shard", F.lit(None).cast("binary"))
    high = heavy.repartition(1).sortWithinPartitions(F.desc("depth"), "key").mapInArrow(_sweep(queue), TOTALS)

    ends = steps.filter(F.col("depth") == F.col("length")).select("key", "conv_id").unionByName(meta.filter("length = 0").select(F.lit(ROOT).alias("key"), "conv_id"))
    runs = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_id_chunks, "key binary, first bigint, ids string")
    shas = runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hash_runs, "key binary, ends_sha256 string")

    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    totals = low.unionByName(high).drop("shard").join(parents, "parent", "left").join(shas, "key", "left")
    return totals.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
         sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, digest) AS turns,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
               lambda c: list_concat([ascii(c)::BIGINT], list_transform(range(8), lambda _: (-1)::BIGINT))))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
  FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, d, turns[1:d] AS path, len(turns) AS n FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = n), '') AS ends,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].t, '[^\x20\x09-\x0D]+')) END AS words
  FROM p GROUP BY d, path),
k AS (SELECT n.d, n.conv_id, count(x.d) AS n_children FROM n LEFT JOIN n x ON x.d = n.d + 1 AND x.path[1:n.d] = n.path GROUP BY n.d, n.conv_id),
s AS (
  SELECT p.d, p.path, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves, CAST(sum((u.n_convs - 1) * u.words) AS BIGINT) AS saved_tokens
  FROM n u JOIN k ON k.d = u.d AND k.conv_id = u.conv_id JOIN p ON p.conv_id = u.conv_id AND p.d <= u.d GROUP BY p.d, p.path)
SELECT n.conv_id, n.d AS depth, a.conv_id AS parent_conv_id, n.n_convs, k.n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN k ON k.d = n.d AND k.conv_id = n.conv_id JOIN s ON s.d = n.d AND s.path = n.path
LEFT JOIN n a ON a.d = n.d - 1 AND a.path = n.path[1:n.d - 1]
"""
