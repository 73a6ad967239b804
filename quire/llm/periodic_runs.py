"""Periodic runs of words by Kruskal over descending LCPs.

The suffixes of each text are sorted by prefix doubling, with a batch of texts
at a time (a word's rank includes its text, so texts never share a prefix) and
only positions whose prefix occurs again carried on. Neighbours in that order are
edges weighted by their longest common prefix (LCP). Edges are taken by
descending LCP: two classes of suffixes are united in a union-find whose classes
keep their positions in order, the smaller class inserted into the larger one.
When two positions i < j become neighbours in a class at the LCP l, exactly l
words match from both on, and no position between them matches as far. So if
their distance d is small enough against l, the words from i to j + l have the
smallest period d and end where the period ends; of these pairs the one whose
preceding words differ is where the run begins. Each run is found once, no
others are, and nothing is compared word by word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.ship import ship
from quire.llm.substring_dedup import _kept_digest
from quire.llm.textarrays import Texts, chunks, combine, text_column

BLOCK = 1024
NONE = 1 << 62


class Positions:
    """Ascending positions in blocks, so that an insertion moves few of them."""

    __slots__ = ("blocks", "heads", "n")

    def __init__(self, x: list[int]):
        self.blocks = [x[i : i + BLOCK] for i in range(0, len(x), BLOCK)]
        self.heads, self.n = [b[0] for b in self.blocks], len(x)

    def __len__(self) -> int:
        return self.n

    def __iter__(self) -> Iterator[int]:
        return chain.from_iterable(self.blocks)

    def add(self, x: int) -> tuple[int, int]:
        """Insert x; its neighbours before (-1: none) and after (very large)."""
        heads, blocks = self.heads, self.blocks
        at = max(bisect_left(heads, x) - 1, 0)
        block = blocks[at]
        self.n += 1
        if x > block[-1]:
            before, after = block[-1], heads[at + 1] if at + 1 < len(heads) else NONE
            block.append(x)
        else:
            i = bisect_left(block, x)
            before, after = block[i - 1] if i else -1, block[i]
            block.insert(i, x)
            heads[at] = block[0]
        if len(block) > 2 * BLOCK:
            blocks.insert(at + 1, block[BLOCK:])
            heads.insert(at + 1, block[BLOCK])
            del block[BLOCK:]
        return before, after


def ranks(names: np.ndarray, doc: np.ndarray, bounds: np.ndarray, shortest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, levels): the positions whose first ``shortest`` words or more occur
    again in their text, in suffix order, and every position's rank by its first
    1, 2, 4, ... words. Equal ranks mean equal words; at a level a suffix that has
    been told apart keeps its rank."""
    n = len(names)
    end = bounds[1:][doc]
    key = combine(names, doc.astype(np.uint64))
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(head, size)
    levels, width = [rank], 1
    kept = live = order[np.repeat(size > 1, size)]
    while len(live):
        ahead = live + width
        inside = ahead < end[live]
        second = np.zeros(len(live), np.int64)
        second[inside] = levels[-1][ahead[inside]] + 1
        first = levels[-1][live]
        by = np.lexsort((second, first))
        live, first, second = live[by], first[by], second[by]
        new = np.ones(len(live), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        group = np.ones(len(live), bool)  # heads of the classes at the last level
        group[1:] = first[1:] != first[:-1]
        head, old = np.flatnonzero(new), np.flatnonzero(group)
        size = np.diff(np.append(head, len(live)))
        place = head - old[np.searchsorted(old, head, side="right") - 1]
        rank = levels[-1].copy()
        rank[live] = np.repeat(first[head] + place, size)
        levels.append(rank)
        width *= 2
        live = live[np.repeat(size > 1, size)]
        if width <= shortest:
            kept = live
    last = levels[-1]
    return kept[np.argsort(last[kept], kind="stable")], levels


def common_prefix(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """Words that match from positions a and b (of one text, a != b) on."""
    got = np.zeros(len(a), np.int64)
    x, y = a.copy(), b.copy()
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        inside = np.maximum(x, y) < end
        idx = np.flatnonzero(inside)
        same = idx[rank[x[idx]] == rank[y[idx]]]
        step = 1 << k
        got[same] += step
        x[same] += step
        y[same] += step
    return got


def find_runs(names: np.ndarray, bounds: np.ndarray, min_length: int = 6, min_times: int = 4) -> np.ndarray:
    """Rows (start, length, period), by start and period, of every maximal run
    of at least ``min_length`` words and ``min_times`` (2 or more) periods;
    ``bounds`` limits the words of each text."""
    none = np.zeros((0, 3), np.int64)
    if not len(names):
        return none
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # a run of period q has an LCP of its length less q: no run has less than this
    least = min(max(min_length - q, (min_times - 1) * q) for q in range(1, min_length + 1))
    order, levels = ranks(names, doc, bounds, least)
    a, b = order[:-1], order[1:]
    pair = doc[a] == doc[b]
    a, b = a[pair], b[pair]
    lcp = common_prefix(a, b, levels, bounds[1:][doc[a]])
    use = lcp >= least
    a, b, lcp = a[use], b[use], lcp[use]
    by = np.argsort(-lcp, kind="stable")
    seeds = kruskal(a[by].tolist(), b[by].tolist(), lcp[by].tolist(), len(names), min_times - 1)
    if not seeds:
        return none
    i, d, lcp = np.array(seeds, np.int64).T
    first = (i == bounds[doc[i]]) | (names[i - 1] != names[i + d - 1])
    runs = np.stack([i, d + lcp, d], axis=1)[first & (d + lcp >= min_length)]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kruskal(a: list[int], b: list[int], lcp: list[int], n: int, times: int) -> list[tuple[int, int, int]]:
    """Seeds (position, distance, LCP): positions that become neighbours in a
    class at a distance of at most LCP / times, over edges (a, b) of descending
    LCP. The neighbours of an inserted position are taken when those of its class
    before and after it are known, and pairs of one class are older ones."""
    parent = list(range(n))
    sets: dict[int, list[int] | Positions] = {}
    seeds = []
    for x, y, level in zip(a, b, lcp, strict=True):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        large, small = sets.pop(x, None) or [x], sets.pop(y, None) or [y]
        if len(small) > len(large):
            large, small, x, y = small, large, y, x
        parent[y] = x
        most, last = level // times, -1
        moved = list(small)
        moved.append(n)
        for q, following in zip(moved, moved[1:], strict=False):
            if isinstance(large, list):
                if q > large[-1]:
                    before, after = large[-1], n
                    large.append(q)
                else:
                    i = bisect_left(large, q)
                    before, after = large[i - 1] if i else -1, large[i]
                    large.insert(i, q)
            else:
                before, after = large.add(q)
            if before != last and q - before <= most:
                seeds.append((before, q - before, level))
            if after < following and after - q <= most:
                seeds.append((q, after - q, level))
            last = q
        sets[x] = Positions(large) if isinstance(large, list) and len(large) > 2 * BLOCK else large
    return seeds


def _runs_of(t: Texts, min_length: int, min_times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(runs, text of each run, words that stay) of a piece of texts."""
    runs = find_runs(t.names, t.bounds, min_length, min_times)
    step = np.zeros(len(t.starts) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return runs, np.searchsorted(t.bounds, runs[:, 0], side="right") - 1, np.cumsum(step)[:-1] == 0


def periodic_runs(
    spark: SparkSession,
    docs: DataFrame,
    min_length: int = 6,
    min_times: int = 4,
    id_col: str = "doc_id",
    text: Column | str = "text",
    kept_as: str = "text",
) -> DataFrame:
    """(id, n_words, runs, start, length, period, kept) of each row.

    ``runs``: every maximal run (start word, length in words, smallest period) of
    at least ``min_length`` words and ``min_times`` periods, by start, then period;
    ``start``, ``length`` and ``period`` are those of the run with the most periods
    (ties: the smallest start, then period; null without runs). ``kept`` is the
    text's words, joined by one space, without those that a run holds after its
    first period, or with ``kept_as="sha256"`` the digest of that. Null and empty
    texts have no words; texts are never cut; repeated rows and ids give repeated
    results; an empty table gives none; only the id and text are read. Words are
    compared by 64-bit names. One pass in Arrow batches, without a shuffle.
    """
    ship(spark)
    as_text = kept_as == "text"
    text = F.col(text) if isinstance(text, str) else text
    src = docs.select(F.col(id_col), F.coalesce(text.cast("string"), F.lit("")).alias("t"))
    kind = src.schema[0].dataType.simpleString()
    row = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def piece(ids: pa.Array, col: pa.Array) -> pa.RecordBatch:
        t = Texts(col)
        runs, owner, stay = _runs_of(t, min_length, min_times)
        edges = np.searchsorted(owner, np.arange(len(col) + 1))
        begin = t.bounds[owner]
        best, kept = [], []
        for r in range(len(col)):
            b, e = t.bounds[r], t.bounds[r + 1]
            own = stay[b:e]
            kept.append(_kept_digest(t, r, None if own.all() else own, as_text))
            mine = (runs[edges[r] : edges[r + 1]] - [[b, 0, 0]]).tolist()
            best.append(min(mine, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3))
        table = [pa.array(runs[:, 0] - begin), pa.array(runs[:, 1].copy()), pa.array(runs[:, 2].copy())]
        lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.StructArray.from_arrays(table, fields=list(row)))
        ends = [pa.array([x[k] for x in best], pa.int64()) for k in range(3)]
        return pa.record_batch([ids, pa.array(t.n_words.astype(np.int64)), lists, *ends, pa.array(kept, pa.string())], names=names)

    names = [id_col, "n_words", "runs", "start", "length", "period", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = text_column(batch.column(1))
            for i, n in chunks(col):
                yield piece(batch.column(0).slice(i, n), col.slice(i, n))

    schema = f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, start long, length long, period long, kept string"
    return src.mapInArrow(run, schema)


def repeated_tail(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text of a row, or, for a tenth of the ids, with a tail that repeats
    from some word on (both chosen by the CRC-32 of the id), to test runs with."""
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != F.lit(""))

    def planted(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1)).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(w, lambda _, i: F.get(w, at(i))), " ")

    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), planted), F.lit(0))).otherwise(F.col(text_col).cast("string"))
