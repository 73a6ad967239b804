"""Threshold buckets (X20): a value against three ascending cut points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(value: Column, cuts: Sequence[float], scores: Sequence[int]) -> Column:
    """``scores[i]`` for the first ``value <= cuts[i]``, else ``scores[-1]``."""
    expr = F.when(value <= F.lit(cuts[0]), F.lit(scores[0]))
    for c, s in zip(cuts[1:], scores[1:-1]):
        expr = expr.when(value <= F.lit(c), F.lit(s))
    return expr.otherwise(F.lit(scores[-1])).cast("int")


def r_score(value: Column, cuts: Sequence[float]) -> Column:
    """Recency: lower is better, 4-3-2-1."""
    return bucket(value, cuts, (4, 3, 2, 1))


def fm_score(value: Column, cuts: Sequence[float]) -> Column:
    """Frequency and monetary value: higher is better, 1-2-3-4."""
    return bucket(value, cuts, (1, 2, 3, 4))
