"""Lookup expressions: first match in an array of structs (J2, X19) and a
query-string parameter (X17)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(arr: Column, pred: Callable[[Column], Column]) -> Column:
    """The first element satisfying ``pred`` (null when none). Unlike
    ``map_from_entries``, duplicate keys are allowed: the first one wins."""
    return F.get(F.filter(arr, pred), 0)


def first_wins_map(entries: Column, key: str, value: str) -> Column:
    """An array of structs as a map in which the first entry of a key wins
    (``map_from_entries`` fails on repeated keys). Sorted by (key, place) once, so
    it takes n log n comparisons; entries without a key are left out."""

    def first(ordered: Column) -> Column:
        firsts = F.filter(ordered, lambda x, i: F.coalesce(F.get(ordered, i - 1)["k"] != x["k"], F.lit(True)))
        return F.map_from_entries(F.transform(firsts, lambda x: F.struct(x["k"], x["v"])))

    placed = F.transform(entries, lambda x, i: F.struct(x[key].alias("k"), i.alias("i"), x[value].alias("v")))
    ordered = F.array_sort(F.filter(placed, lambda x: x["k"].isNotNull()))
    return F.get(F.transform(F.array(ordered), first), 0)  # binds the sorted array once


def query_param(query: Column, name: str) -> Column:
    """Value of the first ``name=...`` pair in an ``&``-separated query string
    (the value may itself hold ``=``)."""
    prefix = f"{name}="
    pair = first_match(F.split(query, "&", -1), lambda p: p.startswith(prefix))
    return F.substring(pair, len(prefix) + 1, 1 << 30)
