"""Pluggable text-in/text-out model hook (R1, R2, R3) and its error routing.

Two kinds of model share one interface:

* ``ExpressionModel`` — a deterministic, rule-based model written as a Column expression
  (used for the deterministic stubs the queries run with, and for heuristic judges).  It
  stays inside whole-stage codegen.
* ``PandasModel`` — a real model behind ``mapInPandas``.  The factory is called once per
  Python worker (cached), prompts travel as Arrow batches, and the model sees batches of
  ``batch_size`` prompts.  A batch that raises a ``RuntimeError`` is retried in halves, so one bad
  prompt only marks that row; ``MemoryError`` (out of memory) fails the task.

Select only the hook's input columns before calling ``apply``: column pruning does not
reach through a Python map.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORKER_CACHE: dict[Any, Any] = {}


class TextModel:
    """Interface: ``name``, ``deterministic`` and ``apply``."""

    name = "model"
    deterministic = True

    def apply(self, df: DataFrame, prompt_col: str, out_col: str, num_samples: int = 1) -> DataFrame:
        """Append ``out_col`` (STRING, or ARRAY<STRING> when num_samples > 1) and ``out_col + '_error'``."""
        raise NotImplementedError


class ExpressionModel(TextModel):
    """``fn(prompt_column[, sample_index])`` → Column.  ``prepare`` may add helper columns
    first (computed once, in their own projection); ``cleanup`` names them for removal."""

    def __init__(self, name: str, fn: Callable[..., Column], deterministic: bool = True, prepare=None, cleanup=()):
        self.name, self.fn, self.deterministic = name, fn, deterministic
        self.prepare, self.cleanup = prepare, list(cleanup)

    def apply(self, df: DataFrame, prompt_col: str, out_col: str, num_samples: int = 1) -> DataFrame:
        if self.prepare is not None:
            df = self.prepare(df)
        if num_samples == 1:
            text = self.fn(F.col(prompt_col))
        else:
            text = F.transform(F.sequence(F.lit(0), F.lit(num_samples - 1)), lambda j: self.fn(F.col(prompt_col), j))
        keep = [F.col(c) for c in df.columns if c not in self.cleanup]
        return df.select(*keep, text.alias(out_col), F.lit(None).cast("string").alias(out_col + "_error"))


class PandasModel(TextModel):
    """``factory()`` returns ``generate(prompts: list[str], num_samples: int) -> list[list[str]]``."""

    def __init__(
        self,
        name: str,
        factory: Callable[[], Callable[[list[str], int], list[list[str]]]],
        batch_size: int = 8,
        deterministic: bool = False,
        cache_key: Any = None,
        count_calls: bool = False,
    ):
        """``count_calls`` adds ``out_col + '_calls'``: in how many model calls the row took part."""
        self.name, self.factory, self.batch_size = name, factory, batch_size
        self.deterministic, self.cache_key, self.count_calls = deterministic, cache_key, count_calls

    def apply(self, df: DataFrame, prompt_col: str, out_col: str, num_samples: int = 1) -> DataFrame:
        out_type = T.StringType() if num_samples == 1 else T.ArrayType(T.StringType())
        schema = T.StructType(
            list(df.schema.fields)
            + [T.StructField(out_col, out_type, True), T.StructField(out_col + "_error", T.StringType(), True)]
            + ([T.StructField(out_col + "_calls", T.IntegerType(), False)] if self.count_calls else [])
        )
        factory, batch_size, key, count_calls = self.factory, self.batch_size, self.cache_key or self.name, self.count_calls

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            generate = _WORKER_CACHE.get(key)
            if generate is None:
                generate = _WORKER_CACHE[key] = factory()
            for pdf in batches:
                texts: list[Any] = []
                errors: list[str | None] = []
                calls: list[int] = []
                prompts = pdf[prompt_col].tolist()
                for start in range(0, len(prompts), batch_size):
                    chunk = prompts[start : start + batch_size]
                    got, errs, made = _call_isolated(generate, chunk, num_samples)
                    texts.extend(got)
                    errors.extend(errs)
                    calls.extend(made)
                out = pdf.copy()
                out[out_col] = [t if num_samples > 1 or t is None else t[0] for t in texts]
                out[out_col + "_error"] = errors
                if count_calls:
                    out[out_col + "_calls"] = calls
                yield out

        return df.mapInPandas(run, schema)


def _fatal(exc: BaseException) -> bool:
    """Out-of-memory fails the task.  Accelerator libraries raise it as a RuntimeError
    subclass (e.g. ``OutOfMemoryError``), so the class name is checked as well."""
    return isinstance(exc, MemoryError) or "OutOfMemory" in type(exc).__name__


def _call_isolated(generate, prompts: list[str], num_samples: int) -> tuple[list, list, list[int]]:
    """(texts, errors, calls that each prompt took part in).  A batch that raises is halved until only the
    prompts that fail on their own are left: a lone bad prompt among n costs about 2 log2(n) calls, not n."""
    texts: list = [None] * len(prompts)
    errors: list[str | None] = [None] * len(prompts)
    calls = [0] * len(prompts)
    todo = [(0, len(prompts))] if prompts else []
    while todo:
        at, to = todo.pop()
        for i in range(at, to):
            calls[i] += 1
        try:
            texts[at:to] = [list(o) for o in generate(prompts[at:to], num_samples)]
        except RuntimeError as exc:
            if _fatal(exc):
                raise
            if to - at == 1:
                errors[at] = f"{type(exc).__name__}: {exc}"
            else:
                half = (at + to) // 2
                todo += [(half, to), (at, half)]
    return texts, errors, calls


def generate_long(
    df: DataFrame, model: TextModel, key: str, prompt_col: str, num_samples: int, out_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """R1 output in long form ``(key, sample_index, text, error, *carry)``, ready for A7.

    Only ``key``, the prompt and ``carry`` columns enter the hook (column pruning does not
    reach through a Python map); carried columns come back on every sample row so the
    regroup can keep them without a join.
    """
    cols = [key, prompt_col] + [c for c in carry if c not in (key, prompt_col)]
    wide = model.apply(df.select(*cols), prompt_col, "__gen", num_samples)
    if num_samples == 1:
        return wide.select(
            key, F.lit(0).alias("sample_index"), F.col("__gen").alias(out_col), F.col("__gen_error").alias("error"), *carry
        )
    return wide.select(
        key,
        F.posexplode_outer("__gen").alias("sample_index", out_col),
        F.col("__gen_error").alias("error"),
        *carry,
    )
