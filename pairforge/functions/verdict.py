"""Strict-yet-tolerant parsing of judge verdicts from free model text, natively.

A verdict is the greedy dot-all span from the first ``{`` to the last ``}``; it must be
exactly one JSON document as Python's ``json`` reads it, and fields convert as Python's
``int()`` does.  Spark's JSON functions are laxer (they stop after the first complete
value), so the span is wrapped in ``[...]`` and parsed as an array that must hold exactly one
object: trailing text, a second object, single quotes, trailing commas, leading zeros and
raw control characters in strings make the whole verdict NULL.  Python's extra number
tokens ``NaN``/``Infinity``/``-Infinity`` are accepted (and fail ``int()`` later), Jackson's
other spellings are not.  Fields are parsed as VARIANT so the JSON type of each value drives
the ``int()`` emulation (J-int); values a VARIANT cannot hold (objects with repeated keys)
fall back to their raw JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge.functions.exprcache import cached_expr
from pairforge.functions.text import strip_ws

_SPAN = r"(?s)\{.*\}"
# Python's json also reads the bare tokens NaN, Infinity and -Infinity, so the parser allows
# non-numeric numbers; the extra spellings only Jackson accepts (+INF, -INF, +Infinity) are
# rejected separately, outside string literals.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true", "allowUnquotedControlChars": "false",
           "allowNumericLeadingZeros": "false", "allowBackslashEscapingAnyCharacter": "false", "mode": "PERMISSIVE"}
_JSON_STRING = r'"(?:[^"\\]++|\\.)*+"'
_NOT_PYTHON_NUMBER = r"[+-]INF|\+Infinity"
_FIELDS = "best variant, worst variant, ranking variant, reason variant"
_NUMERIC = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
# Python int(str): optional sign, ASCII digits with single underscores between groups.
_INT_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_span(text) -> Column:
    """J-span: greedy dot-all span from the first ``{`` to the last ``}``; NULL when absent."""
    s = F.regexp_extract(_c(text), _SPAN, 0)
    return F.when(s != "", s)


def _foreign_number_token(text: Column) -> Column:
    """True when ``text`` holds a non-numeric literal Python's json refuses (outside strings)."""
    outside_strings = F.regexp_replace(text, _JSON_STRING, '""')
    return F.coalesce(text.rlike("INF|Infinity") & outside_strings.rlike(_NOT_PYTHON_NUMBER), F.lit(False))


def _whole(text: Column) -> Column:
    """True when a parser that wraps ``text`` in an object reads on past it, so that no bracket in
    ``text`` closed a wrapper early."""
    wrapped = F.from_json(F.concat(F.lit('{"w":'), text, F.lit(',"end_of_text":1}')), "struct<end_of_text:int>", _STRICT)
    return F.coalesce(wrapped["end_of_text"] == 1, F.lit(False))


def strict_object(span, fields: str = _FIELDS) -> Column:
    """J-strict: the span parsed as exactly one JSON object, else NULL."""
    arr = F.from_json(F.concat(F.lit("["), span, F.lit("]")), f"array<struct<{fields}>>", _STRICT)
    return F.when((F.size(arr) == 1) & _whole(span) & ~_foreign_number_token(span), arr.getItem(0))


def json_int(v) -> Column:
    """J-int: Python ``int(x)`` on a parsed JSON value held as VARIANT; NULL where it raises.

    int → int; float → truncation toward zero (NaN/inf → NULL); bool → 0/1;
    string → stripped, signed ASCII digits (underscores between digits allowed);
    null, arrays and objects → NULL.
    """
    t = F.schema_of_variant(v)
    as_text = strip_ws(F.try_variant_get(v, "$", "string"))
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("int"))
        .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int"))
        .when(t.isin(*_NUMERIC) | t.startswith("DECIMAL"), F.try_variant_get(v, "$", "double").try_cast("int"))
        .when(t == "STRING", F.when(as_text.rlike(_INT_TEXT), F.regexp_replace(as_text, "_", "").try_cast("int")))
    )


def json_reason(v, span=None) -> Column:
    """``parsed.get("reason", "")``: missing → "", JSON null → NULL, string → itself, other → JSON text.

    A value holding an object with repeated keys cannot be a VARIANT (it comes back NULL);
    given the ``span``, its raw JSON text is used instead, as for any other non-string.
    """
    t = F.schema_of_variant(v)
    missing = F.lit("")
    if span is not None:
        raw = F.from_json(span, "struct<reason:string>", _STRICT)["reason"]
        missing = F.coalesce(raw, F.lit(""))
    return (
        F.when(v.isNull(), missing)
        .when(F.is_variant_null(v), F.lit(None).cast("string"))
        .when(t == "STRING", F.try_variant_get(v, "$", "string"))
        .otherwise(F.to_json(v))
    )


def parse_best(text, num_responses) -> Column:
    """J1p: ``{best, reason}`` struct or NULL (F4 range check ``1 <= best <= n``)."""
    obj = strict_object(json_span(text))
    best = json_int(obj["best"])
    n = _c(num_responses) if not isinstance(num_responses, int) else F.lit(num_responses)
    ok = obj.isNotNull() & best.isNotNull() & best.between(1, n)
    return F.when(ok, F.struct(best.alias("best"), json_reason(obj["reason"]).alias("reason")))


def parse_best_worst(text, num_responses) -> Column:
    """J2p: ``{best, worst, reason}`` or NULL; both in range and distinct."""
    obj = strict_object(json_span(text))
    best = json_int(obj["best"])
    worst = json_int(obj["worst"])
    n = _c(num_responses) if not isinstance(num_responses, int) else F.lit(num_responses)
    ok = (
        obj.isNotNull() & best.isNotNull() & worst.isNotNull()
        & best.between(1, n) & worst.between(1, n) & (best != worst)
    )
    return F.when(
        ok, F.struct(best.alias("best"), worst.alias("worst"), json_reason(obj["reason"]).alias("reason"))
    )


def _ranking_items(span: Column, v: Column) -> Column:
    """Iterate ``parsed["ranking"]`` the way Python does, each item through ``int()``.

    array → its elements; string → its characters; object → its keys in document order
    (first occurrence); anything else → NULL (not iterable).
    """
    t = F.schema_of_variant(v)
    elems = F.try_variant_get(v, "$", "array<variant>")
    from_array = F.transform(elems, lambda e: json_int(e))
    chars = F.split(F.try_variant_get(v, "$", "string"), "")
    from_string = F.transform(
        F.when(F.try_variant_get(v, "$", "string") == "", F.array().cast("array<string>")).otherwise(chars),
        lambda ch: F.when(ch.rlike("^[0-9]$"), ch.cast("int")),
    )
    # Variant objects sort their keys; re-read the raw object text to keep document order.
    # The raw text also covers objects with repeated keys, which a VARIANT cannot hold
    # (the variant is NULL while the raw text starts with "{"); keys keep first occurrence.
    raw = F.from_json(span, "struct<ranking:string>", _STRICT)["ranking"]
    keys = F.array_distinct(F.json_object_keys(raw))
    from_object = F.transform(keys, _int_text)
    return (
        F.when(t.startswith("ARRAY"), from_array)
        .when(t == "STRING", from_string)
        .when(t.startswith("OBJECT"), from_object)
        .when(v.isNull() & F.ltrim(raw).startswith("{"), from_object)
    )


def _int_text(s: Column) -> Column:
    st = strip_ws(s)
    return F.when(st.rlike(_INT_TEXT), F.regexp_replace(st, "_", "").try_cast("int"))


def parse_ranking(text, num_items: int = 3) -> Column:
    """J3p + F6: ``{ranking: array<int>, reason}`` when the items are a permutation of 1..n."""
    span = json_span(text)
    obj = strict_object(span)
    items = _ranking_items(span, obj["ranking"])
    all_ints = F.forall(items, lambda x: x.isNotNull())
    is_perm = F.array_sort(items) == F.sequence(F.lit(1), F.lit(num_items))
    ok = obj.isNotNull() & items.isNotNull() & F.coalesce(all_ints, F.lit(False)) & F.coalesce(is_perm, F.lit(False))
    return F.when(ok, F.struct(items.alias("ranking"), json_reason(obj["reason"]).alias("reason")))


def is_valid_json(text) -> Column:
    """F7 content check: the whole text is one JSON document of any type (``json.loads`` succeeds)."""
    arr = F.from_json(F.concat(F.lit("["), _c(text), F.lit("]")), "array<string>", _STRICT)
    return F.coalesce((F.size(arr) == 1) & _whole(_c(text)) & ~_foreign_number_token(_c(text)), F.lit(False))


# ---- DataFrame-level forms ---------------------------------------------------------------
# Column expressions are trees: a sub-expression referenced k times is evaluated (and
# code-generated) k times.  These helpers materialise the span, the parsed object and each
# converted field as their own projection; Catalyst keeps a non-cheap producer such as
# ``from_json`` in its own Project instead of inlining it into every consumer.

def _n(num):
    return F.lit(num) if isinstance(num, int) else _c(num)


@cached_expr
def _span_of(text: str):
    return json_span(text)


@cached_expr
def _obj_of(span: str):
    return strict_object(F.col(span))


@cached_expr
def _int_of(name: str):
    return json_int(F.col(name))


@cached_expr
def _reason_of(name: str, span: str = "__v_span"):
    return json_reason(F.col(name), F.col(span))


@cached_expr
def _items_of(span: str, name: str):
    return _ranking_items(F.col(span), F.col(name))


def _open(df, text: str):
    s = df.withColumn("__v_span", _span_of(text))
    return s.withColumn("__v_obj", _obj_of("__v_span"))


def _close(df, keep, out: str, ok, value):
    return df.select(*[F.col(c) for c in keep], F.when(F.coalesce(ok, F.lit(False)), value).alias(out))


def with_best(df, text: str, num, out: str = "verdict"):
    """``df`` + ``out`` = J1p verdict struct ``{best, reason}`` or NULL."""
    s = _open(df, text).withColumns(
        {"__v_best": _int_of("__v_obj.best"), "__v_reason": _reason_of("__v_obj.reason")}
    )
    ok = F.col("__v_obj").isNotNull() & F.col("__v_best").between(F.lit(1), _n(num))
    return _close(s, df.columns, out, ok, F.struct(F.col("__v_best").alias("best"), F.col("__v_reason").alias("reason")))


def with_best_worst(df, text: str, num, out: str = "verdict"):
    """``df`` + ``out`` = J2p verdict struct ``{best, worst, reason}`` or NULL."""
    s = _open(df, text).withColumns(
        {
            "__v_best": _int_of("__v_obj.best"),
            "__v_worst": _int_of("__v_obj.worst"),
            "__v_reason": _reason_of("__v_obj.reason"),
        }
    )
    n = _n(num)
    ok = (
        F.col("__v_obj").isNotNull() & F.col("__v_best").between(F.lit(1), n) & F.col("__v_worst").between(F.lit(1), n)
        & (F.col("__v_best") != F.col("__v_worst"))
    )
    verdict = F.struct(F.col("__v_best").alias("best"), F.col("__v_worst").alias("worst"), F.col("__v_reason").alias("reason"))
    return _close(s, df.columns, out, ok, verdict)


def with_ranking(df, text: str, num_items: int = 3, out: str = "parsed"):
    """``df`` + ``out`` = J3p/F6 ``{ranking, reason}`` or NULL."""
    s = _open(df, text).withColumns(
        {
            "__v_items": _items_of("__v_span", "__v_obj.ranking"),
            "__v_reason": _reason_of("__v_obj.reason"),
        }
    )
    items = F.col("__v_items")
    ok = (
        F.col("__v_obj").isNotNull() & items.isNotNull() & F.forall(items, lambda x: x.isNotNull())
        & (F.array_sort(items) == F.sequence(F.lit(1), F.lit(num_items)))
    )
    return _close(s, df.columns, out, ok, F.struct(items.alias("ranking"), F.col("__v_reason").alias("reason")))
