"""Resume and leakage anti-joins (D1, D2, D2b) and per-system assembly (D3).

All are declarative joins: Catalyst plans broadcast when AQE sees a small side at runtime
and a shuffle join otherwise, so the membership set may outgrow memory without code changes.
None is a positional zip: systems are matched by id.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from pairforge.operators.sketch import bit_set, exclude_prefiltered, hash_bits


def resume_pending(rows: DataFrame, done: DataFrame | None, key: str = "example_id") -> DataFrame:
    """Rows whose ``key`` is not in ``done`` (missing output = nothing done).

    The done side is reduced to its distinct ids first (A6), so repeated appends of the
    same id do not inflate the join.

    Place it before any inference hook: a filter above ``mapInPandas`` is not pushed below it.
    """
    if done is None:
        return rows
    return rows.join(done.select(key).distinct(), key, "left_anti")


def _same_text(left: DataFrame, right: DataFrame, col: str):
    """Join condition for exact text equality keyed by a fixed-size digest.

    Shuffle and sort keys are ``(sha2, length)``; the texts themselves are compared only
    as a residual check on matched digests (``instr(a, b) = 1`` with equal lengths is
    ``a = b``), so multi-kilobyte strings are never hashed for partitioning or sorted.
    """
    return (
        (left["__k"] == right["__k"])
        & (F.length(left[col]) == F.length(right["__t"]))
        & (F.instr(left[col], right["__t"]) == 1)
    )


def exclude_by_text(rows: DataFrame, used: DataFrame | None, col: str = "prompt", prefilter: bool = True) -> DataFrame:
    """Drop rows whose ``col`` equals any text in ``used`` (exact string equality).

    Keyed by the text's digest (see ``_same_text``); an anti-join needs no distinct right side;
    left duplicates survive (bag semantics, not EXCEPT).  With ``prefilter`` a sized Bloom sketch of the
    used texts lets the rows that certainly differ pass without a shuffle (see ``sketch``).
    """
    if used is None:
        return rows
    if prefilter:
        return exclude_prefiltered(rows, used, col, lambda some, texts: exclude_by_text(some, texts, col, prefilter=False))
    right = used.select(F.sha2(F.col(col), 256).alias("__k"), F.col(col).alias("__t"))
    left = rows.withColumn("__k", F.sha2(F.col(col), 256))
    return left.join(right, _same_text(left, right, col), "left_anti").drop("__k")


def flag_by_text(rows: DataFrame, used: DataFrame, col: str = "prompt", flag: str = "leaked") -> DataFrame:
    """D2b helper: mark rows whose text appears in ``used`` (semi-join as a boolean)."""
    right = used.select(F.sha2(F.col(col), 256).alias("__k"), F.col(col).alias("__t"), F.lit(True).alias(flag)).distinct()
    left = rows.withColumn("__k", F.sha2(F.col(col), 256))
    out = left.join(right, _same_text(left, right, col), "left").drop(right["__k"])
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop("__k", "__t")


def leakage_audit(rows: DataFrame, used: DataFrame, group: Sequence[str] = ("split",), col: str = "prompt") -> DataFrame:
    """Per group, how many rows (and distinct texts) also occur in ``used``."""
    flagged = flag_by_text(rows, used, col)
    return flagged.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("leaked")).alias("n_leaked"),
        F.count_distinct(F.when(F.col("leaked"), F.col(col))).alias("n_leaked_distinct"),
    )


def assemble_systems(
    long_outputs: DataFrame, key: str, system: str = "system", text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """D3: long ``(key, system, text)`` → one row per key with ``MAP<system, text>``.

    Groups hold one row per system, so the collect is bounded by the number of systems.
    ``carry`` columns are identical on every row of a key (the hooks pass their inputs
    through), so they ride along in the same aggregation instead of a join back.
    """
    return long_outputs.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(system), F.col(text)))).alias("responses"),
        *[F.any_value(c).alias(c) for c in carry],
    )


WORD_SPLIT = r"[ \t\n\x0B\f\r]+"

#: Short passages up to this many are looked for in one narrow pass over the texts; more are joined by letter grams.
FEW_SHORT = 20_000


def _words(text):
    return F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")


def _chained_ngrams(word_hashes, L: int):
    """Chained hashes of every run of ``L`` consecutive word hashes, in position order.

    Built from ``L`` shifted slices combined with ``zip_with``: L array allocations per
    document instead of one per position.  Documents shorter than ``L`` give an empty list.
    """
    n = F.size(word_hashes) - F.lit(L - 1)
    shifted = [F.slice(word_hashes, j + 1, F.greatest(n, F.lit(0))) for j in range(L)]
    h = shifted[0]
    for s in shifted[1:]:
        h = F.zip_with(h, s, lambda a, b: F.xxhash64(a, b))
    return F.when(n > 0, h).otherwise(F.array().cast("array<bigint>"))


def _letter_grams(word: str, g: int):
    at = F.sequence(F.lit(1), F.length(word) - F.lit(g - 1))
    return F.array_distinct(F.transform(at, lambda i: F.substr(F.col(word), i, F.lit(g))))


def text_containment(
    docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id",
    doc_text: str = "text", item_text: str = "text", anchor_words: int = 8, few_short: int = FEW_SHORT,
) -> DataFrame:
    """D2b over free text: every ``(doc, item)`` where the item's text occurs inside the doc.

    Exact, without comparing all pairs.  If a document contains an item, every *interior*
    word of the item (not the first or last, which may be glued to neighbouring text) is a
    whole word of the document, so the item's first interior word n-gram is one of the
    document's word n-grams.  Items are keyed by that anchor's hash, documents emit the
    hashes of their word n-grams of the anchor lengths in use (at most ``anchor_words``
    distinct lengths), an equi-join yields candidates, and ``instr`` confirms each one.
    Only n-grams whose hash is in a bit array of the anchors (a Bloom sketch of bounded size) are exploded.
    Items of one or two words have no interior word.  Up to ``few_short`` of them (counted) are looked for by a
    pattern automaton in one narrow pass over the texts.  Beyond that, as their first word is part of some word of the document, its
    first three letters (or all) are looked up among the letter grams of the documents' distinct words.
    Items without words are no passages and have no rows.
    """
    it = items.select(F.col(item_key), F.col(item_text).alias("__itext")).withColumn("__w", _words(F.col("__itext")))
    n = F.size("__w")
    it = it.withColumn("__L", F.least(F.lit(anchor_words), n - 2))
    # Each word is hashed once; an n-gram key chains the word hashes left to right:
    # h = xxhash64(...xxhash64(xxhash64(w1, w2), w3)..., wL).
    it = it.withColumn("__wh", F.transform("__w", lambda w: F.xxhash64(w)))
    anchor = F.aggregate(
        F.slice("__wh", 3, F.col("__L") - 1), F.get(F.col("__wh"), 1), lambda acc, x: F.xxhash64(acc, x)
    )
    anchored = it.filter(F.col("__L") >= 1).select(item_key, "__itext", "__L", anchor.alias("__h"))
    counts = {r[0]: r[1] for r in anchored.groupBy("__L").count().collect()}  # at most anchor_words lengths
    lengths = sorted(counts)
    anchors = hash_bits(anchored, "__h", sum(counts.values())) if lengths else None
    d = docs.select(F.col(doc_key), F.transform(_words(F.col(doc_text)), lambda w: F.xxhash64(w)).alias("__w"))
    grams = None
    for L in lengths:
        g = d.select(
            doc_key,
            F.lit(L).alias("__L"),
            F.explode(F.filter(_chained_ngrams(F.col("__w"), L), lambda h: bit_set(anchors, h))).alias("__h"),
        )
        grams = g if grams is None else grams.unionByName(g)
    cands = it.filter(F.lit(False)).select(F.lit(None).cast(docs.schema[doc_key].dataType).alias(doc_key), item_key)
    if grams is not None:
        cands = grams.join(anchored.select(item_key, "__L", "__h"), ["__L", "__h"]).select(doc_key, item_key).distinct()
    short = it.filter((F.col("__L") < 1) & (n > 0))
    listed = short.select(item_key, "__itext").limit(few_short + 1).collect()
    by_pass = None
    if listed and len(listed) <= few_short and importlib.util.find_spec("ahocorasick"):
        by_pass = _short_pass(docs.select(doc_key, doc_text), [tuple(r) for r in listed], items.schema[item_key])
    elif listed:
        found = _short_candidates(docs, short, doc_key, item_key, doc_text)
        cands = found if grams is None else cands.unionByName(found)
    if grams is None and by_pass is not None:
        return by_pass
    # Candidates are few: joined to the documents they name (AQE broadcasts them when their
    # runtime size allows, otherwise it is a shuffle join), then confirmed verbatim.
    texts = docs.select(F.col(doc_key), F.col(doc_text).alias("__dtext"))
    confirmed = (
        texts.join(cands, doc_key)
        .join(it.select(item_key, "__itext"), item_key)
        .filter(F.instr(F.col("__dtext"), F.col("__itext")) > 0)
        .select(doc_key, item_key)
    )
    return confirmed if by_pass is None else confirmed.unionByName(by_pass)


def _short_pass(docs: DataFrame, passages: Sequence[tuple], item: StructField) -> DataFrame:
    """(doc, item) of every passage inside a document's text: one pass of a pattern automaton over the texts,
    which stay where they are.  ``docs`` has a key and a text."""
    key, text = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for _, passage in passages:
            automaton.add_word(passage, passage)
        automaton.make_automaton()
        ids: dict[str, list] = {}
        for i, passage in passages:
            ids.setdefault(passage, []).append(i)
        for b in batches:
            found = [(r, i) for r, t in enumerate(b.column(text.name).to_pylist()) if t for p in {x for _, x in automaton.iter(t)} for i in ids[p]]
            rows = pa.array([r for r, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(key.name).take(rows), pa.array([i for _, i in found], to_arrow_type(item.dataType))], names=[key.name, item.name])

    return docs.mapInArrow(run, StructType([key, item]))


def _short_candidates(docs: DataFrame, short: DataFrame, doc_key: str, item_key: str, doc_text: str) -> DataFrame:
    """(doc, item) candidates of items of one or two words, by letter grams over the vocabulary."""
    short = short.withColumn("__first", F.get(F.col("__w"), 0))
    short = short.withColumn("__g", F.least(F.lit(3), F.length("__first"))).withColumn("__gram", F.substr("__first", F.lit(1), F.col("__g")))
    grams_in_use = [r[0] for r in short.select("__g").distinct().collect()]  # at most three values
    doc_words = docs.select(doc_key, F.explode(F.array_distinct(_words(F.col(doc_text)))).alias("__word"))
    vocabulary = doc_words.select("__word").distinct()
    pieces = None
    for g in grams_in_use:
        p = vocabulary.filter(F.length("__word") >= g).select("__word", F.lit(g).alias("__g"), F.explode(_letter_grams("__word", g)).alias("__gram"))
        pieces = p if pieces is None else pieces.unionByName(p)
    holding = pieces.join(short.select(item_key, "__first", "__g", "__gram"), ["__g", "__gram"]).filter(F.col("__word").contains(F.col("__first")))
    return doc_words.join(holding.select("__word", item_key).distinct(), "__word").select(doc_key, item_key).distinct()


def config_mismatches(generated: DataFrame, expected: DataFrame | None = None, **expected_values) -> DataFrame:
    """Q6: resume ignores ``gen_config``; count rows generated under a different config.

    ``expected_values`` names the fields to compare (e.g. ``model_id=..., seed=42``).
    """
    differs = [F.col(f"gen_config.{k}") != F.lit(v) for k, v in expected_values.items()]
    any_diff = differs[0]
    for d in differs[1:]:
        any_diff = any_diff | d
    return generated.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(any_diff).alias("n_config_mismatch"))
