"""Every registered query against its DuckDB oracle at sf0.001, plus the entry smoke check."""

import duckdb
import pytest

import __spark_entry__ as E
from pairforge.sources.tables import TABLES
from tests.conftest import SF_SMALL



def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, f"{v:.9g}")
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, int):
        return (1, f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x) for x in v))
    return (5, str(v))


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "chosen" in df.columns


@pytest.mark.parametrize("name", sorted(E.REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    assert _canon(rows, cols) == _canon(res.fetchall(), dcols)
