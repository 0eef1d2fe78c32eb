"""Line dedup by site-relative frequency (native DataFrame functions only).

For each host the pages that hold a line are divided by the pages of the host; lines above the
boilerplate ratio are dropped from every page of that host.

Scale: lines are hashed on the map side and counted by (host, digest) with partial aggregation, so
a line on every page of a hot host costs one row per task.  The ratios of one host's lines sum to
its mean number of distinct lines a page, hence a host has at most (mean lines a page / ratio)
boilerplate lines: their digests fit one array per host, joined through a counted table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import join_small_by_key, materialize

#: A line on more than this share of its host's pages is boilerplate: footers and notices stand on a few per cent ...
RATIO = 0.02
#: ... if it is on at least this many pages, which guards hosts of up to MIN_PAGES / RATIO pages.
MIN_PAGES = 5
#: The per-host table is broadcast up to this many hosts.
MAX_BROADCAST_HOSTS = 20_000
STRIP = " \t\r"


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(STRIP)).cast("binary")))


def _not_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(STRIP)) != ""


def boilerplate(docs: DataFrame, host: str, text: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, ``_drop``): the digests of the host's boilerplate lines; hosts without any have no row."""
    own = F.array_distinct(F.transform(F.filter(F.split(F.col(text), "\n"), _not_blank), _digest))
    counts = docs.select(host, F.explode(own).alias("_line")).groupBy(host, "_line").agg(F.count(F.lit(1)).alias("_k"))
    pages = docs.groupBy(host).agg(F.count(F.lit(1)).alias("_pages")).withColumnRenamed(host, "_host")
    frequent = counts.filter(F.col("_k") >= min_pages)
    return (
        frequent.join(pages, F.col(host).eqNullSafe(F.col("_host")))
        .filter(F.col("_k") > F.col("_pages") * F.lit(ratio))
        .groupBy(host)
        .agg(F.collect_list("_line").alias("_drop"))
    )


def drop_boilerplate_lines(
    docs: DataFrame,
    *,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    doc_id: str = "doc_id",
    host: str = "source",
    text: str = "text",
    max_broadcast: int = MAX_BROADCAST_HOSTS,
) -> DataFrame:
    """``docs`` with ``text`` cleaned, ``n_lines`` and ``n_dropped``.

    Lines are the pieces between line feeds; they are compared without blanks, tabs and carriage
    returns at their ends, blank lines are neither counted nor dropped, and kept lines stay as
    they are.  Every row is a page: repeated rows count each.  A null host is a host of its own.
    A null text has 0 lines and stays null, an empty text has one blank line.  Columns of
    ``docs`` named ``n_lines`` or ``n_dropped`` are replaced.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    drops = materialize(boilerplate(docs.select(host, text), host, text, ratio, min_pages), "boilerplate")
    joined = join_small_by_key(docs, drops, host, F.col(doc_id), max_broadcast)
    lines = F.split(F.col(text), "\n")
    kept = F.when(
        F.col("_drop").isNotNull(),
        F.filter(lines, lambda x: ~(_not_blank(x) & F.array_contains(F.col("_drop"), _digest(x)))),
    ).otherwise(lines)
    out = joined.withColumn("_kept", kept)
    n_lines = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("bigint")
    n_kept = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size("_kept")).cast("bigint")
    cols = [(F.array_join("_kept", "\n") if c == text else F.col(f"`{c}`")).alias(c) for c in keep]
    return out.select(*cols, n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"))


ORACLE = f"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
m AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS t FROM l),
f AS (SELECT source, t, count(DISTINCT doc_id) AS k FROM m WHERE t <> '' GROUP BY source, t),
h AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (SELECT f.source, f.t FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source WHERE k >= {MIN_PAGES} AND k > pages * CAST({RATIO} AS DOUBLE)),
g AS (SELECT m.doc_id, count(*) AS n_lines, count(b.t) AS n_dropped,
             coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (WHERE b.t IS NULL), '') AS kept
      FROM m LEFT JOIN b ON m.source IS NOT DISTINCT FROM b.source AND m.t = b.t GROUP BY m.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE kept END AS text, lang, source, n_chars,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN g USING (doc_id)
"""
