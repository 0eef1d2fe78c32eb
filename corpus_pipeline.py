"""From raw documents to encoded training text, one written table after another.

Each stage reads all rows its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm import bpe, jaccard, lines, mixing, toxicity
from pairforge.llm.common import materialize, table

#: The toxicity stage is a trained model, which SQL cannot express; the stages are tested one by one.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model rejects go.

    Null and empty texts have no words and stay; repeated rows are judged alike; an empty table stays empty.
    Columns named like a result of the model (severity, p_toxic, grade, rejected) hold that result afterwards.
    """
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("NOT rejected").select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go, no document does.

    A null source is a source; a null text stays null; repeated rows lose the same lines; an empty table stays
    empty.  Columns named n_lines or n_dropped hold the stage's counts afterwards.
    """
    return lines.drop_boilerplate_lines(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; of rows that share an id, one.

    Documents without words, and rows without an id, link with nothing and stay.
    """
    found = materialize(jaccard.near_duplicates(docs), "near-duplicates")
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)
    ids = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.filter("n > 1").isEmpty():
        return kept
    # an id of many rows: the rows' digests are counted first, so that no task gathers its texts
    mark = "_row"
    while mark in docs.columns:
        mark += "_"
    row = materialize(kept.withColumn(mark, F.monotonically_increasing_id()), "repeated-ids")
    first = row.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), mark))[mark].alias(mark))
    return row.filter("doc_id IS NULL").drop(mark).union(row.join(first.hint("merge"), ["doc_id", mark], "left_semi").select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat (or go) so that sources reach their target weights, and are shuffled globally.

    A null source is a source; null and empty texts repeat like others; an empty table stays empty.  Columns
    named copy_no or mix_key hold the copy's number and place afterwards.
    """
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded of every row; a null text is empty; only doc_id and text are read."""
    return bpe.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
