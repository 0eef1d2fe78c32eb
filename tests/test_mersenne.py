"""The vectorised shuffle equals the standard library's generator."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairforge import constants as C
from pairforge.functions import mersenne as M
from pairforge.operators import evaluate as EV
from pairforge.sources import tables as TB
from tests.conftest import SF_SMALL


def library(seed, n):
    items = list(range(n))
    random.Random(seed).shuffle(items)
    return items


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 40])
def test_equals_the_library(n):
    seeds = np.array([0, 1, 42, -1, -42, 2**31, 2**32 - 1, 2**32, 2**33 + 5, 2**63 - 1, -(2**63), *range(100, 2000)], np.int64)
    assert M.shuffled(seeds, n).tolist() == [library(int(s), n) for s in seeds]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=20), st.integers(1, 300))
def test_any_seed_and_length(seeds, n):
    """Long lists need more words than one state row gives and fall back to the library."""
    assert M.shuffled(np.array(seeds, np.int64), n).tolist() == [library(s, n) for s in seeds]


def test_column_for_every_example(spark):
    rows = TB.examples(spark, SF_SMALL).select("example_id", EV.blind_labels_exact(F.col("example_id")).alias("o")).collect()
    for r in rows:
        items = list(C.SYSTEMS)
        random.Random(C.DEFAULT_SEED + r.example_id).shuffle(items)
        assert r.o == items
    nulls = spark.createDataFrame([(None,), (7,)], "k long").select("k", EV.blind_labels_exact(F.col("k")).alias("o")).collect()
    assert {r.k: r.o is None for r in nulls} == {None: True, 7: False}


def test_blind_evaluation_takes_the_exact_order(spark):
    from pairforge.functions import stub_models as S

    examples = EV.all_examples(TB.examples(spark, SF_SMALL))
    rows = EV.prepare_blind(examples, S.stub_systems(), exact=True).collect()
    assert rows
    for r in rows:
        items = list(C.SYSTEMS)
        random.Random(C.DEFAULT_SEED + r.eval_id).shuffle(items)
        assert r.label_to_model == {str(i): s for i, s in enumerate(items, 1)}
        assert r.labelled_responses == [r.responses[s] for s in items]
