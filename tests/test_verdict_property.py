"""Property test: the native verdict parser agrees with Python's own json/int semantics on
generated judge replies (prose around JSON, value types, whitespace, duplicates, trailing
text).  One Spark job evaluates every generated case."""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairforge.functions import verdict as V

N = 4


def _as_python_int(value):
    """``int(value)`` as Python evaluates it, or None where it would raise."""
    try:
        return int(value)
    except (ValueError, TypeError, OverflowError):
        return None


def python_semantics(text: str):
    """Expected verdict from the standard library's behaviour: the text between the first
    ``{`` and the last ``}`` must decode as one JSON document whose ``best`` converts with
    ``int()`` into 1..N."""
    first, last = text.find("{"), text.rfind("}")
    if first < 0 or last < first:
        return None
    try:
        doc = json.loads(text[first : last + 1])
    except ValueError:
        return None
    if "best" not in doc:
        return None
    n = _as_python_int(doc["best"])
    return n if n is not None and 1 <= n <= N else None


ascii_ws = st.sampled_from(["", " ", "  ", "\t", "\n", " \n "])
values = st.one_of(
    st.integers(min_value=-3, max_value=9).map(str),
    st.floats(min_value=-2, max_value=7, allow_nan=False).map(lambda x: repr(round(x, 2))),
    st.sampled_from(["true", "false", "null", "[1]", "{}", "NaN", "1e400", "2e0", "02", "1_0", "-0.0"]),
    st.tuples(ascii_ws, st.integers(min_value=-1, max_value=6), ascii_ws).map(lambda t: json.dumps(f"{t[0]}{t[1]}{t[2]}")),
    st.sampled_from(['"+2"', '"2.0"', '" 3 "', '"x"', '""', '"1_2"']),
)
extras = st.sampled_from(["", ', "reason": "r"', ', "reason": null', ', "reason": {"a": 1}', ', "best": 2', ', "worst": 1', ","])
prose = st.sampled_from(["", "Sure. ", "Answer:\n", "{", "}"])
tails = st.sampled_from(["", " done", " {\"best\": 1}", "}", "\n"])


@st.composite
def replies(draw):
    quote = draw(st.sampled_from(['"', "'"]))
    body = "{" + draw(ascii_ws) + f"{quote}best{quote}:" + draw(ascii_ws) + draw(values) + draw(extras) + draw(ascii_ws) + "}"
    return draw(prose) + body + draw(tails)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(replies(), min_size=150, max_size=150))
def test_native_parser_matches_python_semantics(spark, cases):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r.i: (r.v.best if r.v else None) for r in df.select("i", V.parse_best(F.col("t"), N).alias("v")).collect()}
    for i, text in enumerate(cases):
        want = python_semantics(text)
        if want is not None and isinstance(want, int) and math.isfinite(want):
            assert got[i] == want, text
        else:
            assert got[i] is None, text


def _python_items(value):
    """Python's iteration of a decoded JSON value: list elements, string characters or
    object keys; numbers, booleans and null are not iterable (None)."""
    if isinstance(value, (list, str, dict)):
        return list(value)
    return None


def python_ranking(text: str):
    first, last = text.find("{"), text.rfind("}")
    if first < 0 or last < first:
        return None
    try:
        doc = json.loads(text[first : last + 1])
    except ValueError:
        return None
    items = _python_items(doc.get("ranking")) if "ranking" in doc else None
    if items is None:
        return None
    ints = [_as_python_int(x) for x in items]
    if any(i is None for i in ints) or sorted(ints) != [1, 2, 3]:
        return None
    return ints


elements = st.one_of(
    st.integers(min_value=0, max_value=4).map(str),
    st.sampled_from(['"1"', '"2"', '"3"', '" 2"', '"2.0"', "2.0", "3.9", "true", "null", "[1]", '"01"']),
)
ranking_values = st.one_of(
    st.lists(elements, min_size=0, max_size=4).map(lambda xs: "[" + ", ".join(xs) + "]"),
    st.permutations(["1", "2", "3"]).map(lambda p: json.dumps("".join(p))),
    st.sampled_from(['"12"', '"1 23"', '"1234"', '"+123"', '""', "123", "null", "true", "{}"]),
    st.permutations(["1", "2", "3"]).map(lambda p: "{" + ", ".join(f'"{k}": 0' for k in p) + "}"),
    st.sampled_from(['{"1": 0, "1": 1, "2": 0, "3": 0}', '{" 1": 0, "2": 0, "3": 0}', '{"01": 0, "2": 0, "3": 0}']),
)


@st.composite
def ranking_replies(draw):
    body = '{"ranking": ' + draw(ranking_values) + draw(st.sampled_from(["", ', "reason": "r"', ', "ranking": [3, 2, 1]'])) + "}"
    return draw(prose) + body + draw(tails)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ranking_replies(), min_size=150, max_size=150))
def test_native_ranking_matches_python_semantics(spark, cases):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    rows = df.select("i", V.parse_ranking(F.col("t"), 3).alias("v")).collect()
    got = {r.i: (list(r.v.ranking) if r.v else None) for r in rows}
    for i, text in enumerate(cases):
        assert got[i] == python_ranking(text), text


def python_best_worst(text: str):
    first, last = text.find("{"), text.rfind("}")
    if first < 0 or last < first:
        return None
    try:
        doc = json.loads(text[first : last + 1])
    except ValueError:
        return None
    if "best" not in doc or "worst" not in doc:
        return None
    b, w = _as_python_int(doc["best"]), _as_python_int(doc["worst"])
    if b is None or w is None or not (1 <= b <= N and 1 <= w <= N) or b == w:
        return None
    return (b, w)


@st.composite
def best_worst_replies(draw):
    body = '{"best": ' + draw(values) + ', "worst": ' + draw(values) + draw(extras) + "}"
    return draw(prose) + body + draw(tails)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(best_worst_replies(), min_size=150, max_size=150))
def test_native_best_worst_matches_python_semantics(spark, cases):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    rows = df.select("i", V.parse_best_worst(F.col("t"), N).alias("v")).collect()
    got = {r.i: ((r.v.best, r.v.worst) if r.v else None) for r in rows}
    for i, text in enumerate(cases):
        assert got[i] == python_best_worst(text), text
