"""Queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairforge.llm import bpe, collocations, fingerprint, html_text, jaccard, lines, mixing, posting_lists, prefix_trie, quality, substrings, topk, toxicity
from pairforge.llm.common import table

Run = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.drop("text")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_table(table(spark, sf_dir, "embeddings"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate_lines(table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search_table(table(spark, sf_dir, "embeddings"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Run] = {f.__name__: f for f in (op1_quality, op2_substrings, op3_bpe, op4_fingerprint, op5_mixing, op6_toxicity, op7_topk, op8_lines, op9_html, op10_jaccard, op11_collocations, op12_neighbours, op13_trie)}

#: DuckDB SQL where SQL can express the operator; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op5_mixing": mixing.ORACLE, "op7_topk": topk.ORACLE, "op8_lines": lines.ORACLE, "op11_collocations": collocations.ORACLE, "op13_trie": prefix_trie.ORACLE}
