"""Toxicity by cumulative-link ordinal regression on sparse text features.

``P(grade <= k) = sigmoid(theta_k - w . x)``: one weight vector shared by the ordered thresholds.
The expected severity is the sum of ``P(grade >= k)``.

Scale: vocabulary and weights are fitted on a bounded sample of labelled rows (parameters below);
scoring is one map over the documents with a vocabulary of bounded size in the closure.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import hash_order_sample, in_stage, materialize

#: Bounds of the fit: labelled rows a class, and terms in the vocabulary.
SAMPLE_ROWS, VOCABULARY = 6000, 1000
#: A term enters the vocabulary only if it is in at least this many sampled documents.
MIN_DOCS = 3
WORD = re.compile(r"[^\W\d_]+")
#: Lengths of word beginnings that are terms beside the words, for languages that inflect.
BEGINNINGS = (4, 5)
KNOWN_WORDS = 150_000


@dataclass(frozen=True)
class OrdinalModel:
    words: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; one less than there are grades


def terms(word: str) -> list[str]:
    """The word, and its beginnings marked by a trailing ``-``."""
    return [word, *[word[:n] + "-" for n in BEGINNINGS if len(word) >= n]]


def features(text: str | None, words: dict[str, int], known: dict[str, tuple[int, ...]]) -> tuple[list[int], list[float], int]:
    """Indices and values (log of 1 + count) of the vocabulary's terms in the whole text, and its number of words.

    ``known`` remembers the terms of words seen before, up to KNOWN_WORDS of them.
    """
    if len(known) > KNOWN_WORDS:
        known.clear()
    found = WORD.findall((text or "").lower())
    counts: dict[int, int] = {}
    for w, c in Counter(found).items():
        mine = known.get(w)
        if mine is None:
            mine = known[w] = tuple([words[t] for t in terms(w) if t in words])
        for i in mine:
            counts[i] = counts.get(i, 0) + c
    return list(counts), [math.log1p(c) for c in counts.values()], len(found)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_ordinal(rows: list[tuple[list[int], list[float]]], grades: np.ndarray, size: int, *, ridge: float = 5e-5, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the likelihood less a ridge penalty, by full-batch Adam."""
    n, k = len(rows), int(grades.max()) if len(grades) else 1
    index = np.fromiter((i for r in rows for i in r[0]), np.int64)
    value = np.fromiter((v for r in rows for v in r[1]), float)
    row = np.repeat(np.arange(n), [len(r[0]) for r in rows])
    above = np.array([(grades >= j).mean() for j in range(1, k + 1)])
    start = np.log((1 - above + 1e-3) / (above + 1e-3))
    # free parameters: weights, first threshold, logs of the gaps between thresholds
    par = np.concatenate([np.zeros(size), start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, gaps = par[:size], np.exp(par[size + 1 :])
        theta = np.concatenate([[-np.inf], par[size] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        s = np.bincount(row, value * w[index], n)
        lo, hi = _sigmoid(theta[grades] - s), _sigmoid(theta[grades + 1] - s)
        prob = np.maximum(hi - lo, 1e-12)
        ds = hi + lo - 1  # derivative of the log-likelihood in s
        dt = np.zeros((n, k + 2))
        dt[at, grades + 1] += hi * (1 - hi) / prob
        dt[at, grades] -= lo * (1 - lo) / prob
        dt = dt[:, 1:-1].mean(0)
        grad = np.concatenate([np.bincount(index, value * ds[row], size) / n - ridge * w, [dt.sum()], [dt[j:].sum() * gaps[j - 1] for j in range(1, k)]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        par += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return par[:size].copy(), par[size] + np.concatenate([[0], np.cumsum(np.exp(par[size + 1 :]))])


def vocabulary(sample: DataFrame, size: int = VOCABULARY) -> dict[str, tuple[int, float]]:
    """term -> (index, z): the terms whose document frequency differs most between the classes."""

    @in_stage("toxicity")
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for y, t in zip(b.column("_toxic").to_pylist(), b.column("text").to_pylist(), strict=True):
                both[y > 0].update({x for w in set(WORD.findall((t or "").lower())) for x in terms(w)})
            every = list(both[True] | both[False])
            yield pa.record_batch([pa.array(every, pa.string()), pa.array([both[True][w] for w in every], pa.int64()), pa.array([both[False][w] for w in every], pa.int64())], ["word", "t", "c"])

    n = {r["y"]: r["n"] for r in sample.groupBy((F.col("_toxic") > 0).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    nt, nc = n.get(True, 0), n.get(False, 0)
    freq = sample.select("_toxic", "text").mapInArrow(words, "word string, t bigint, c bigint").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    pt, pc = (F.col("t") + 0.5) / (nt + 1.0), (F.col("c") + 0.5) / (nc + 1.0)
    z = (pt - pc) / F.sqrt(pt * (1 - pt) / (nt + 1.0) + pc * (1 - pc) / (nc + 1.0))
    top = freq.filter(F.col("t") + F.col("c") >= MIN_DOCS).withColumn("z", z).orderBy(F.abs("z").desc(), "word").limit(size).select("word", "z").collect()
    return {r.word: (i, r.z) for i, r in enumerate(top)}


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic") -> OrdinalModel:
    """Fit on at most SAMPLE_ROWS labelled rows of either class whose ``crc32(id) % 4`` is not 2.

    ``label`` holds ordered grades 0, 1, 2, ...; there is a threshold between any two grades that follow each
    other, and one set of weights.  If it only marks 0 and 1, there are two grades and the severity is the
    probability of the second.  Rows without a label are ignored; without both classes every severity is 0.
    """
    rows = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("_toxic"))
    rows = rows.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    ids = hash_order_sample(rows.filter("_toxic > 0"), "doc_id", SAMPLE_ROWS).union(hash_order_sample(rows.filter("_toxic <= 0"), "doc_id", SAMPLE_ROWS))
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "toxicity-sample")  # SAMPLE_ROWS bounds what is broadcast
    vocab = vocabulary(sample)
    words = {w: i for w, (i, _) in vocab.items()}

    @in_stage("toxicity")
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for b in batches:
            got = [features(t, words, known) for t in b.column("text").to_pylist()]
            yield pa.record_batch(
                [b.column("doc_id"), b.column("_toxic"), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.float64())), pa.array([g[2] for g in got], pa.int64())],
                ["doc_id", "_toxic", "i", "v", "n"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = sample.select("doc_id", "_toxic", "text").mapInArrow(sparse, f"doc_id {kind}, _toxic int, i array<int>, v array<double>, n bigint").collect()
    got.sort(key=lambda r: (r["doc_id"], r["n"], r["i"]))
    grades = np.array([max(0, r["_toxic"]) for r in got], dtype=np.int64)
    if not len(grades) or grades.min() > 0 or grades.max() == 0:
        return OrdinalModel(words, np.zeros(len(words)), np.array([1e3]))
    share = {y: r for y, r in ((r["y"], r["n"]) for r in rows.groupBy((F.col("_toxic") > 0).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect())}
    weights, thresholds = fit_ordinal([(r["i"], r["v"]) for r in got], grades, len(words))
    # The sample takes as many rows of either class as it can; the shift gives each its share among the labels.
    shift = np.log((grades > 0).sum() / (grades == 0).sum()) - np.log(share[True] / share[False])
    return OrdinalModel(words, weights, thresholds + shift)


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Every column of ``docs`` with ``severity`` (expected grade), ``p_toxic`` (of any grade but 0),
    ``grade`` (the likeliest) and ``rejected`` (``p_toxic >= 0.5``).

    Null and empty texts have no words; repeated rows and equal texts get equal results.  Columns
    of ``docs`` with those names are replaced.  An empty table gives an empty result.
    """
    new = ("severity", "p_toxic", "grade", "rejected")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    names = docs.columns

    @in_stage("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for b in batches:
            s = np.zeros(b.num_rows)
            for r, t in enumerate(b.column("text").to_pylist()):
                i, v, _ = features(t, model.words, known)
                s[r] = float(np.dot(model.weights[i], v)) if i else 0.0
            atleast = 1 - _sigmoid(model.thresholds[None, :] - s[:, None])  # P(grade >= 1), P(grade >= 2), ...
            each = -np.diff(np.column_stack([np.ones(len(s)), atleast, np.zeros(len(s))]), axis=1)
            yield pa.record_batch([*b.columns, pa.array(atleast.sum(1)), pa.array(atleast[:, 0]), pa.array(each.argmax(1).astype("int32")), pa.array(atleast[:, 0] >= 0.5)], [*names, *new])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, severity double, p_toxic double, grade int, rejected boolean")
