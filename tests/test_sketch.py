"""The Bloom prefilter of the leakage anti-join (D2): same rows with any sketch, few rows shuffled."""

import pytest
from pyspark.sql import functions as F

from pairforge.operators import joins as J
from pairforge.operators import sketch as SK


def _texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, prompt string")


@pytest.mark.parametrize("most_bits", [SK.MOST_BITS, 10])
def test_same_rows_as_the_plain_anti_join(spark, most_bits):
    rows = _texts(spark, [f"p{i % 300}" for i in range(600)] + [None, None, "", "é", "É"])
    used = _texts(spark, [f"p{i}" for i in range(0, 300, 3)] + [None, "é", "é"])
    got = SK.exclude_prefiltered(rows, used, "prompt", lambda a, b: J.exclude_by_text(a, b, prefilter=False), most_bits)
    want = J.exclude_by_text(rows, used, prefilter=False)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()) and got.columns == rows.columns


def test_most_rows_pass_without_a_shuffle(spark):
    rows, used = _texts(spark, [f"row {i}" for i in range(20_000)]), _texts(spark, [f"row {i}" for i in range(0, 2000, 10)] + [f"other {i}" for i in range(800)])
    sketch = SK.build(used, "prompt", 1000)
    assert sketch.chance < 0.02
    hits = {r.id for r in rows.filter(SK.may_contain(sketch, F.col("prompt"))).collect()}
    assert set(range(0, 2000, 10)) <= hits and len(hits) - 200 < 2.5 * sketch.chance * 20_000 + 50
    assert J.exclude_by_text(rows, used).count() == 19_800


def test_sizes_and_fallback(spark):
    assert SK.size_of(0)[0] == SK.LEAST_BITS and SK.size_of(10**9)[0] == SK.MOST_BITS
    assert SK.size_of(1000)[1] < 0.02 < 0.5 < SK.size_of(10**9)[1]
    rows, used = _texts(spark, ["a", "b"]), _texts(spark, [])
    assert SK.exclude_prefiltered(rows, used, "prompt", lambda *_: pytest.fail("nothing to exclude")) is rows
    calls = []
    SK.exclude_prefiltered(rows, _texts(spark, [str(i) for i in range(2000)]), "prompt", lambda a, b: calls.append((a, b)) or a, most_bits=10)
    assert len(calls) == 1 and calls[0][0] is rows  # too many for the sketch: the plain anti-join


def test_one_shuffled_side_of_few_rows(spark):
    """The rows that pass are no child of the anti-join's exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = J.exclude_by_text(_texts(spark, [f"row {i}" for i in range(500)]), _texts(spark, ["row 3"]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Union" in plan and "LeftAnti" in plan
    assert "hashpartitioning(__k" not in plan[plan.index("Union") : plan.index("LeftAnti")]
    assert plan.count("Exchange hashpartitioning(__k") == 2  # both sides of the anti-join, of which one holds the hits only
