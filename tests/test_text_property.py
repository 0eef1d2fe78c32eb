"""Property test: W1/P3/P4 agree with Python's str methods on random Unicode text."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pairforge.functions import text as T

WS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
pieces = st.one_of(st.text(alphabet=WS, max_size=3), st.text(max_size=6), st.sampled_from(["Assistant:", "Assistant: ", "assistant:"]))
texts = st.lists(pieces, max_size=6).map("".join)


def py_strip_prefix(t):
    rest = t.removeprefix("Assistant:")
    return rest.lstrip() if rest is not t else t


def py_ensure_prefix(t):
    s = t.strip()
    return s if s.startswith("Assistant:") else "Assistant: " + s


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=200, max_size=200))
def test_text_ops_match_python(spark, cases):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    rows = df.select(
        "i", T.strip_ws("t").alias("s"), T.lstrip_ws("t").alias("l"),
        T.strip_assistant_prefix("t").alias("p3"), T.ensure_assistant_prefix("t").alias("p4"),
    ).collect()
    for r in rows:
        t = cases[r.i]
        assert (r.s, r.l, r.p3, r.p4) == (t.strip(), t.lstrip(), py_strip_prefix(t), py_ensure_prefix(t)), repr(t)
