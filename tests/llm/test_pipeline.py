"""The pipeline on a small table, and the queries that SQL can express against it."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from pairforge.llm import bpe, lines, mixing, toxicity
from pairforge.llm.common import materialize
from pairforge.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_operators import brute_components, odd_texts
from tests.test_queries import _canon


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.collect(), df.columns) == _canon(res.fetchall(), cols)


def _plain_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _in_sql(spark, df, sql, folder, columns):
    """Rows of ``sql`` over ``df`` as the table documents."""
    df.write.parquet(folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    return sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall(), key=str)


def test_each_stage_equals_a_plain_version_on_its_own_input(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages, columns = dict(P.STAGES), docs.columns
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    rejected = {r.doc_id for r in toxicity.score(docs, model).filter("rejected").collect()}
    clean = materialize(stages["toxicity"](spark, docs, SF_SMALL), "t")
    assert _plain_rows(clean) == _plain_rows(docs.filter(~docs["doc_id"].isin(*rejected)) if rejected else docs)
    lined = materialize(stages["line dedup"](spark, clean, SF_SMALL), "l")
    assert _plain_rows(lined) == _in_sql(spark, clean, lines.ORACLE, scratch + "/clean", columns)
    unique = materialize(stages["near duplicates"](spark, lined, SF_SMALL), "n")
    component = {d: c for d, _, c in brute_components([(r.doc_id, r.text, None) for r in lined.collect()])}
    assert _plain_rows(unique) == _plain_rows(lined.filter(lined["doc_id"].isin(*[d for d, c in component.items() if d == c])))
    mixed = materialize(stages["mixing"](spark, unique, SF_SMALL), "m")
    assert _plain_rows(mixed) == _in_sql(spark, unique, mixing.ORACLE, scratch + "/unique", columns)
    own = bpe.Bpe(bpe.default_vocabulary())
    want = []
    for r in mixed.collect():
        ids = own.whole.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), " ".join(map(str, ids)), own.whole.decode(ids, skip_special_tokens=False)))
    assert _plain_rows(stages["bpe"](spark, mixed, SF_SMALL)) == sorted(want, key=str)


def test_stages_on_empty_and_odd_tables(spark):
    """Nulls, long and repeated texts, equal ids; more columns whose names clash with what stages compute."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, severity string, rejected string, n_lines int, copy_no string, _row int, n int"
    rows = [(d, t, "en", s, 1, "x", "y", 7, "z", 1, 2) for d, t, s in odd_texts()]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all((r.lang, r.n_chars) == ("en", 1) for r in got), name  # a column of a computed name holds what was computed
        assert {r.doc_id for r in got} <= {r[0] for r in rows}, name
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name
    assert P.encode(spark, docs, SF_SMALL).count() == len(rows) and P.encode(spark, docs.limit(0), SF_SMALL).count() == 0


def test_near_duplicates_keep_one_row_of_an_id(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (2, "A b c d e f", "en", "s", 1), (3, None, "en", "s", 1), (None, "a b c d e f", "en", "s", 1)]
    few = spark.createDataFrame(rows, docs.schema)
    assert sorted((r.doc_id for r in P.drop_near_duplicates(spark, few, SF_SMALL).collect()), key=str) == [1, 3, None]


def test_run(spark):
    out = E.queries()["pipeline"](spark, SF_SMALL)
    assert {"doc_id", "n_tokens", "ids", "decoded"} == set(out.columns) and out.count() > 100
