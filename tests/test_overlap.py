"""Verbatim containment (D2b) for passages of any number of words."""

import pytest

from pairforge.operators.joins import text_containment


@pytest.mark.parametrize("few_short", [20_000, 3])
def test_short_and_long_passages(spark, few_short):
    """Both ways for short passages: one narrow pass, or letter grams once there are too many for it."""
    docs = [(1, "alpha beta gamma delta"), (2, "xbeta gammay"), (3, "zeta"), (4, ""), (5, None)]
    items = [(10, "beta gamma"), (11, "zzz yyy"), (12, "eta"), (13, "a"), (14, "alpha beta gamma"), (15, ""), (16, " "), (17, "gamma  delta")]
    got = text_containment(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), few_short=few_short)
    want = [(d, i) for d, t in docs for i, x in items if t and x.strip() and x in t]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_anchor_bits_never_drop_a_passage(spark):
    words = [f"w{i}" for i in range(50)]
    docs = [(d, " ".join(words[(7 * d + 3 * i) % 50] for i in range(60))) for d in range(40)]
    items = [(i, " ".join(docs[i % 40][1].split()[i % 20 : i % 20 + 3 + i % 11])) for i in range(200)]
    got = text_containment(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted((d, i) for d, t in docs for i, x in items if x in t)
