"""Mixing sources to target weights by Poisson replication (native DataFrame functions only).

The mean repetition rate of a source is ``N * share / n`` where ``share`` is its target share of
the mixture and ``n`` its row count.  Each document draws its count by inverting the Poisson
distribution of that mean at a uniform number hashed from (seed, document), is exploded by the
count, and the copies are shuffled globally by a hash of (seed, document, copy).

Scale: one narrow aggregate by source (combined map-side, so a hot source costs one row per
task), a broadcast of the per-source table behind a count of its rows (a salted join beyond it),
and one shuffle of the replicated documents on a random key, which no source can skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import join_small_by_key

#: Largest mean that one inversion handles; a larger mean is the sum of equal independent draws.
MAX_MEAN = 32.0
#: The per-source table (name, mean, one distribution table) is broadcast up to this many rows.
MAX_BROADCAST_SOURCES = 10_000
TWO_52 = float(2**52)


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) from the first 52 bits of the MD5 of the parts joined by ``|``."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(TWO_52)


def _cdf(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until the rest is below the resolution of the uniform number."""
    last = F.ceil(mean + F.lit(10.0) * F.sqrt(mean) + F.lit(30.0)).cast("int")
    first = F.exp(-mean)
    step = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"),
            F.array_append(a["c"], F.element_at(a["c"], -1) + a["p"] * mean / k).alias("c"),
        ),
    )
    return step["c"]


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None, source: str, temperature: float, total: float | None) -> DataFrame:
    """One row per source: ``_draws`` (how many independent draws) and ``_cdf`` of one draw.

    With ``weights`` None the target weight of a source is ``n ** temperature``.  A source not
    named in ``weights`` has weight 0.
    """
    stats = docs.groupBy(source).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    if weights is None:
        share = F.pow(F.col("_n"), F.lit(float(temperature)))
    else:
        share = F.lit(0.0)
        for name, w in weights.items():
            share = F.when(F.col(source).eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(share)
    stats = stats.withColumn("_w", share)
    sums = stats.agg(F.sum("_n").alias("n"), F.sum("_w").alias("w")).first()
    rows, wsum = (sums["n"] or 0.0), (sums["w"] or 0.0)
    target = rows if total is None else float(total)
    mean = F.lit(target) * F.col("_w") / F.lit(wsum if wsum > 0 else 1.0) / F.col("_n")
    return (
        stats.withColumn("_mean", mean)
        .withColumn("_draws", F.greatest(F.lit(1), F.ceil(F.col("_mean") / F.lit(MAX_MEAN))).cast("int"))
        .select(source, "_draws", _cdf(F.col("_mean") / F.col("_draws")).alias("_cdf"))
    )


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    *,
    seed: int = 17,
    temperature: float = 0.5,
    total: float | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    max_broadcast: int = MAX_BROADCAST_SOURCES,
) -> DataFrame:
    """``docs`` replicated to the target weights, with ``copy_no`` (from 1) and ``mix_key`` (the
    global order: partitions are dealt by it and sorted by it).

    A null source is a source of its own.  Null or empty texts are replicated like others.  A
    null id draws by the MD5 of its text.  Repeated rows (same id) draw the same count each.
    Columns of ``docs`` named ``copy_no`` or ``mix_key`` are replaced; other columns, whatever
    their names, stay.  An empty table gives an empty result.
    """
    keep = [c for c in docs.columns if c not in ("copy_no", "mix_key")]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    rates = source_rates(docs.select(source), weights, source, temperature, total)
    ident = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.col(text).cast("binary")), F.lit(""))
    joined = join_small_by_key(docs.withColumn("_ident", ident), rates, source, F.col("_ident"), max_broadcast)
    draw = lambda j: F.size(F.filter(F.col("_cdf"), lambda c: c <= uniform(F.lit(str(seed)), F.col("_ident"), j.cast("string"))))
    counted = joined.withColumn("_count", F.aggregate(F.transform(F.sequence(F.lit(1), F.col("_draws")), draw), F.lit(0), lambda a, x: a + x))
    copies = counted.filter(F.col("_count") > 0).withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_count"))))
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.col("_ident"), F.col("copy_no").cast("string")).cast("binary"))
    keyed = copies.withColumn("mix_key", F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint"))
    return keyed.select(*[F.col(f"`{c}`") for c in keep], "copy_no", "mix_key").repartition(F.col("mix_key")).sortWithinPartitions("mix_key")


#: The same mixture in DuckDB SQL for the default parameters (means up to MAX_MEAN).
ORACLE = """
WITH s AS (SELECT source, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n) AS total, sum(sqrt(n)) AS w FROM s),
r AS (SELECT source, total * sqrt(n) / w / n AS mean FROM s, t),
k AS (SELECT source, mean, unnest(range(0, CAST(ceil(mean + 10 * sqrt(mean) + 30) AS BIGINT) + 1)) AS k FROM r),
c AS (SELECT source, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
a AS (SELECT source, list(cdf) AS cdf FROM c GROUP BY source),
d AS (SELECT d.*, len(list_filter(cdf, lambda x: x <= CAST('0x' || substr(md5('17|' || doc_id || '|1'), 1, 13) AS BIGINT) / 4503599627370496.0)) AS cnt
      FROM documents d JOIN a ON d.source IS NOT DISTINCT FROM a.source),
e AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(1, cnt + 1)) AS copy_no FROM d)
SELECT doc_id, text, lang, source, n_chars, CAST(copy_no AS INTEGER) AS copy_no,
       CAST('0x' || substr(md5('17-order|' || doc_id || '|' || copy_no), 1, 15) AS BIGINT) AS mix_key
FROM e
"""
