"""Quality by compression: two zstandard dictionaries, one trained on good and one on bad text.

A text is compressed block by block with either dictionary; the difference of the two sizes over
the text's size is the evidence, and a logistic curve fitted on labelled rows that neither
dictionary has seen turns it into a score.

Scale: fitting reads a bounded sample (parameters below); scoring is one map over the documents,
with two dictionaries of fixed size shipped in the closure.  Nothing is shuffled but the sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import hash_order_sample, materialize

#: Bounds of the fit: labelled rows a class for the dictionaries and for the curve, and pieces a class.
DICT_ROWS, CURVE_ROWS, DICT_PIECES = 1500, 2000, 6000
PIECE_BYTES, BLOCK_BYTES, DICT_BYTES, LEVEL = 2048, 8192, 112_640, 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class QualityModel:
    """``slope * evidence + offset`` is the log-odds of a good text; without dictionaries every score is the prior."""

    good: bytes
    bad: bytes
    slope: float
    offset: float


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def evidence(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    """(size with the bad dictionary - size with the good one) / bytes, summed over all blocks of each whole text."""
    make = lambda d: zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
    g, b = make(good), make(bad)
    out = np.zeros(len(texts))
    for i, t in enumerate(texts):
        if t:
            raw = t.encode()
            blocks = [raw[k : k + BLOCK_BYTES] for k in range(0, len(raw), BLOCK_BYTES)]
            out[i] = sum(len(b.compress(x)) - len(g.compress(x)) for x in blocks) / len(raw)
    return out


def logistic_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a small ridge so that separable classes stay finite."""
    scale = float(np.std(x)) or 1.0
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        grad = z.T @ (p - y) + 1e-2 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, good, piece = [], [], []
        for d, q, t in zip(b.column("doc_id").to_pylist(), b.column("_good").to_pylist(), b.column("text").to_pylist(), strict=True):
            raw = (t or "").encode()
            for k in range(0, len(raw), PIECE_BYTES):
                ids.append(f"{d}:{k}")
                good.append(q)
                piece.append(raw[k : k + PIECE_BYTES])
        yield pa.record_batch([pa.array(ids, pa.string()), pa.array(good, pa.int32()), pa.array(piece, pa.binary())], ["piece_id", "_good", "piece"])


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality") -> QualityModel:
    """Fit on labelled rows whose id leaves 0, 1 (dictionaries) or 3 (curve) by ``crc32(id) % 4``.

    At most DICT_ROWS + CURVE_ROWS rows and DICT_PIECES pieces a class are used.  Rows without a
    label are ignored; if a class is missing, the model has no dictionaries and scores the prior.
    """
    rows = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_good"))
    rows = rows.withColumn("_rem", remainder(F.col("doc_id"))).filter("_rem <> 2")
    parts = [
        hash_order_sample(rows.filter((F.col("_good") == q) & ((F.col("_rem") == 3) == curve)), "doc_id", n)
        for q in (0, 1)
        for curve, n in ((False, DICT_ROWS), (True, CURVE_ROWS))
    ]
    ids = parts[0].union(parts[1]).union(parts[2]).union(parts[3])  # DICT_ROWS and CURVE_ROWS bound what is broadcast
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "quality-sample")
    pieces = sample.filter("_rem <> 3").select("doc_id", "_good", "text").mapInArrow(_pieces, "piece_id string, _good int, piece binary")
    trained = []
    for q in (1, 0):
        got = hash_order_sample(pieces.filter(F.col("_good") == q), "piece_id", DICT_PIECES).select("piece").collect()
        try:
            trained.append(zstandard.train_dictionary(DICT_BYTES, [bytes(r.piece) for r in got]).as_bytes())
        except zstandard.ZstdError:  # too little text to train on
            trained.append(zstandard.ZstdCompressionDict(b"".join(bytes(r.piece) for r in got)[:DICT_BYTES]).as_bytes())
    good, bad = trained

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column("_good"), pa.array(evidence(b.column("text").to_pylist(), good, bad))], ["_good", "x"])

    curve = sample.filter("_rem = 3").select("_good", "text").mapInArrow(measured, "_good int, x double").collect()
    # The sample takes as many rows of either class as it can; weights give each class its share among the labels.
    shares = {r["_good"]: r["n"] for r in rows.groupBy("_good").agg(F.count(F.lit(1)).alias("n")).collect()}
    x, y = np.array([r.x for r in curve]), np.array([float(r["_good"]) for r in curve])
    if len(shares) < 2 or len(set(y.tolist())) < 2:
        prior = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1)
        return QualityModel(b"", b"", 0.0, math.log(prior / (1 - prior)))
    slope, offset = logistic_curve(x, y)
    shift = math.log(shares[1] / shares[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return QualityModel(good, bad, slope, offset + shift)


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (columns doc_id and text are read, others ignored).

    Null and empty texts have no evidence and get the curve's value at 0.  Repeated rows and equal
    texts get equal scores.  A null id is not held out.  An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = evidence(b.column("text").to_pylist(), model.good, model.bad) if model.slope else np.zeros(b.num_rows)
            s = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -500, 500)))
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype("int32"))], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held, "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
