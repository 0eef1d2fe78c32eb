"""Strict verdict parsing against the hand-made rows of FIXTURES §4."""

import pytest
from pyspark.sql import functions as F

from pairforge.functions import verdict as V

BEST_CASES = [
    ('x {"best": 2, "reason": "a"} y', 2), ("{'best':1}", None), ('{"best":1} and {"best":2}', None),
    ('{"best":1,}', None), ('{"best":1},{"best":2}', None), ('{"best":NaN}', None), ('{"best":"2"}', 2),
    ('{"best":1, "reason":{"a":1}}', 1), ('{"best":" 2 "}', 2), ('{"best":1, "reason":null}', 1),
    ('{"best":2.9}', 2), ('{"a":{"best":2}}', None), ('{"best":"2.0"}', None), ('{"best":2e0}', 2),
    ('{"best":true}', 1), ('{"best":1_0}', None), ('{"best":null}', None), ('{"best":"+2"}', 2),
    ('{"best":[1]}', None), ('{"best":2}}', None), ('{"best":1,"best":3}', 3), ('{"best":-0.5}', None),
    ("none", None), ('{"best":02}', None), ('{\n"best":\n4}', 4), ('{"best":1,"reason":"a\nb"}', None),
    ('{"best":5}', None), ('{"best":1e400}', None), ('{"reason":"x"}', None),
    ('{"best":3, "reason":"uses } brace"} ok', 3), ('{}{"best":1}', None),
]


def _run(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_best_31_cases(spark):
    got = _run(spark, [t for t, _ in BEST_CASES], lambda c: V.parse_best(c, 4))
    assert len(BEST_CASES) == 31
    for (text, want), v in zip(BEST_CASES, got):
        assert (v.best if v else None) == want, text


def test_best_dataframe_form_agrees(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(BEST_CASES)], "i int, t string")
    got = V.with_best(df.withColumn("n", F.lit(4)), "t", "n").orderBy("i").collect()
    assert [(r.verdict.best if r.verdict else None) for r in got] == [w for _, w in BEST_CASES]


def test_best_worst(spark):
    cases = [('{"best":1,"worst":4}', (1, 4)), ('{"best":2,"worst":2}', None), ('{"best":1}', None),
             ('{"best":1,"worst":5}', None)]
    got = _run(spark, [t for t, _ in cases], lambda c: V.parse_best_worst(c, 4))
    assert [((v.best, v.worst) if v else None) for v in got] == [w for _, w in cases]


def test_ranking(spark):
    cases = [('{"ranking":[2,1,3]}', [2, 1, 3]), ('{"ranking":["2","1","3"]}', [2, 1, 3]),
             ('{"ranking":"213"}', [2, 1, 3]), ('{"ranking":{"1":0,"3":0,"2":0}}', [1, 3, 2]),
             ('{"ranking":[1,2.0,3]}', [1, 2, 3]), ('{"ranking":[1,1,3]}', None), ('{"ranking":[1,2]}', None),
             ('{"ranking":[1,2,3,4]}', None), ('{"ranking":null}', None), ('{"ranking":3}', None)]
    got = _run(spark, [t for t, _ in cases], lambda c: V.parse_ranking(c, 3))
    assert [(list(v.ranking) if v else None) for v in got] == [w for _, w in cases]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    rows = V.with_ranking(df, "t", 3).orderBy("i").collect()
    assert [(list(r.parsed.ranking) if r.parsed else None) for r in rows] == [w for _, w in cases]


@pytest.mark.parametrize(
    "text,reason",
    [('{"best":1}', ""), ('{"best":1,"reason":null}', None), ('{"best":1,"reason":"x"}', "x"),
     ('{"best":1,"reason":{"a":1}}', '{"a":1}'), ('{"best":1,"reason":2.5}', "2.5")],
)
def test_reason_types(spark, text, reason):
    v = _run(spark, [text], lambda c: V.parse_best(c, 4))[0]
    assert v.reason == reason


def test_is_valid_json(spark):
    texts = ['{"k": 1}', "[1]", "3", '"x"', '{"a":1} x', "", "null", "{'a':1}"]
    got = _run(spark, texts, V.is_valid_json)
    assert got == [True, True, True, True, False, False, True, False]


def test_brackets_do_not_close_the_wrapper(spark):
    texts = ['1],[2', "1] junk", '{"a":1}],[{"a":2}', '{"a":1,"a":2}', '{"best":1},"w":{}', "[1,2]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.v for r in df.select(V.is_valid_json("t").alias("v")).collect()] == [False, False, False, True, False, True]
    spans = spark.createDataFrame([('[{"best": 1}], [{"best": 2}]',), ('{"best":1} ] trailing }',), ('{"best":1}',)], "t string")
    assert [r.v for r in spans.select(V.strict_object(V.json_span("t")).isNotNull().alias("v")).collect()] == [False, False, True]
