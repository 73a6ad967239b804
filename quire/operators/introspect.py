"""Introspection (K9-K11): schema trees and plans as text, for logs and
tests, through the public ``printSchema`` / ``explain`` methods."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def _captured(fn) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        fn()
    return buf.getvalue()


def schema_text(df: DataFrame) -> str:
    """``printSchema`` output."""
    return _captured(df.printSchema)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """``explain(mode)`` output: simple, extended, codegen, cost or formatted."""
    return _captured(lambda: df.explain(mode=mode))


def stream_plan_text(q: StreamingQuery, extended: bool = False) -> str:
    """Plan of the last micro-batch of a running (or finished) query."""
    return _captured(lambda: q.explain(extended))
