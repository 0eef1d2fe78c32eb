"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven code points ends a chunk wherever it hits the block size; every chunk
gives one symbol of the signature.  The block size comes from the length and is then halved or
doubled by the chunks it makes; if the passages of a repetitive text all end at once or not at
all, every second, fourth, ... end counts and the block size grows by that factor.  A fingerprint holds the block size, the signature at it and
the one at twice it; two fingerprints are compared by edit distance where their block sizes meet.

Scale: fingerprinting is a map.  The edited text of a document needs its neighbour in the global
order of ids, so the documents are range-partitioned once by id (any tie split further) and each
task walks its sorted range; only the first and last row of a range meet the neighbouring task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import materialize

WINDOW, LEAST_BLOCK, SYMBOLS, LEAST_SYMBOLS, MOST_SYMBOLS, COMMON = 7, 3, 64, 16, 96, 5
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_M1, _M2, _P = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0x100000001B3)
_SYMBOL = np.frombuffer(ALPHABET.encode(), np.uint8)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def rolling(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the last WINDOW code points at each position (fewer at the start)."""
    v = codes.astype(np.uint64) * _M1
    h = v.copy()
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(1, min(WINDOW, len(v))):
            power = power * _P
            h[j:] += v[:-j] * power
    h ^= h >> np.uint64(32)
    h *= _M2
    h ^= h >> np.uint64(29)
    return h


def _signature(h: np.ndarray, ends: np.ndarray) -> str:
    """One symbol for each chunk; from the MOST_SYMBOLS-th chunk on, the rest of the text is one chunk."""
    starts = np.concatenate([[0], ends[: MOST_SYMBOLS - 1] + 1])
    starts = starts[starts < len(h)]
    sums = np.add.reduceat(h, starts) * _M1
    return _SYMBOL[(sums >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(codes: np.ndarray) -> str:
    """``block:signature:signature at twice the block`` of a text given as code points."""
    block = LEAST_BLOCK
    while block * SYMBOLS < len(codes):
        block *= 2
    if not len(codes):
        return f"{block}::"
    h = rolling(codes)
    low = h & np.uint64(0xFFFFFFFF)

    def ends_at(size: int) -> np.ndarray:
        return np.flatnonzero(low % np.uint64(size) == size - 1)

    def too_few(ends: np.ndarray) -> bool:
        """Too few chunks, or one of more than a third of the text."""
        return len(ends) < LEAST_SYMBOLS or 3 * int(np.diff(ends, prepend=-1, append=len(h) - 1).max()) > len(h)

    ends = ends_at(block)
    while block > 1 and len(h) > LEAST_BLOCK * SYMBOLS and too_few(ends):
        block //= 2
        ends = ends_at(block)
    while len(ends) >= MOST_SYMBOLS and not too_few(more := ends_at(2 * block)):
        block, ends = 2 * block, more
    step = 1
    while len(ends) >= MOST_SYMBOLS * step:
        step *= 2
    ends = ends[step - 1 :: step]
    twice = ends[1::2] if step > 1 else ends[low[ends] % np.uint64(2 * block) == 2 * block - 1]
    return f"{block * step}:{_signature(h, ends)}:{_signature(h, twice)}"


def _likeness(a: str, b: str) -> float:
    """1 - (insertions and deletions) / symbols, 0 without a common substring of COMMON symbols (or of the shorter one)."""
    if a == b:
        return 1.0
    n = min(COMMON, len(a), len(b))
    if not n or not {a[i : i + n] for i in range(len(a) - n + 1)} & {b[i : i + n] for i in range(len(b) - n + 1)}:
        return 0.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full  # longest common subsequence, one bit per symbol of a
    for c in b:
        u = row & where.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return 2.0 * (len(a) - row.bit_count()) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """Of two fingerprints, 0 to 1; 0 where their block sizes differ by more than a factor of two."""
    if x == y:
        return 1.0
    (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")
    p, q = int(bx), int(by)
    if p == q:
        return max(_likeness(x1, y1), _likeness(x2, y2))
    if p == 2 * q:
        return _likeness(x1, y2)
    if q == 2 * p:
        return _likeness(x2, y1)
    return 0.0


def _compared(text: str, own: str, after: str, after_print: str) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    mark = fingerprint(code_points(edited))
    return len(text), hashlib.sha256(edited.encode()).hexdigest(), own, mark, likeness(own, mark), likeness(own, after_print)


_RESULT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row (a null text is empty; equal texts have equal fingerprints)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [code_points(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array([len(c) for c in codes], pa.int64()), pa.array([fingerprint(c) for c in codes], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, f"doc_id {kind}, n_chars bigint, fingerprint string")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness (see ``_NAMES``).

    The next document is the one after it in descending doc_id (null ids come last, rows with one
    id are ordered by a hash of their text); after the last comes the first.  The edited text has
    the last floor(n / 2) code points replaced by the first as many (or all) of the next document.
    A null text is empty; two empty texts have likeness 1.  A table of one row is its own next.
    Only doc_id and text are read; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_hash", F.xxhash64("text")).withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col("doc_id").desc_nulls_last(), F.col("_hash"), F.col("_tie")]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = ["_part", "_kind", "doc_id", "_text", *_NAMES]
        empty = (None,) * len(_NAMES)
        before = None
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            out = []
            for d, t in zip(ids, texts, strict=True):
                mark = fingerprint(code_points(t))
                if before is None:
                    out.append(("head", d, t, empty))
                else:
                    out.append(("done", before[0], None, _compared(before[1], before[2], t, mark)))
                before = (d, t, mark)
            yield pa.record_batch([pa.array([part] * len(out), pa.int32()), pa.array([o[0] for o in out]), pa.array([o[1] for o in out], b.schema.field("doc_id").type), pa.array([o[2] for o in out], pa.string()), *_columns([o[3] for o in out])], names)
            kind_of = b.schema.field("doc_id").type
        if before is not None:
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array(["tail"]), pa.array([before[0]], kind_of), pa.array([before[1]], pa.string()), *_columns([empty])], names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [_compared(t, fingerprint(code_points(t)), a, fingerprint(code_points(a))) for t, a in zip(b.column("_text").to_pylist(), b.column("_after").to_pylist(), strict=True)]
            yield pa.record_batch([b.column("doc_id"), *_columns(got)], ["doc_id", *_NAMES])

    walked = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(walk, f"_part int, _kind string, doc_id {kind}, _text string, {_RESULT}")
    walked = materialize(walked, "fingerprints")
    # One head and one tail a partition: their numbers go to the driver, their texts stay in the tables.
    parts = sorted(r["_part"] for r in walked.filter("_kind = 'head'").select("_part").collect())
    following = docs.sparkSession.createDataFrame([(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "_part int, _next int")
    heads = walked.filter("_kind = 'head'").select(F.col("_part").alias("_next"), F.col("_text").alias("_after"))
    tails = walked.filter("_kind = 'tail'").select("_part", "doc_id", "_text").join(following, "_part").join(heads, "_next").select("doc_id", "_text", "_after")
    return walked.filter("_kind = 'done'").select("doc_id", *_NAMES).union(tails.mapInArrow(finish, f"doc_id {kind}, {_RESULT}"))
