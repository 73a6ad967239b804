from __future__ import annotations

from collections import defaultdict

import pytest
from test_support import SCHEMA, empty_docs, key, odd_docs, odd_rows, prose, words

from quire.llm.source_mix import mix


def targets(sizes, cap=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        out = {s: cap * sizes[s] if s in full else left * weight[s] / w for s in names}
        over = {s for s in names if s not in full and out[s] > cap * sizes[s] + 1e-9}
        if not over:
            return out
        full |= over


def test_odd_rows(spark):
    got = mix(spark, odd_docs(spark)).collect()
    size = defaultdict(int)
    for r in odd_rows():
        size[r[3]] += len(words(r[1]))
    want = targets(size)
    by_id = {key(r[0]): r for r in odd_rows()}
    assert len(got) == len(odd_rows())
    for r in got:
        src = by_id[key(r.doc_id)]
        assert r.size == len(words(src[1])) and r.source_size == size[src[3]]
        assert r.target == pytest.approx(want[src[3]])
        assert 0 <= r.taken <= 3 * r.size
    assert mix(spark, empty_docs(spark)).collect() == []
    assert sorted(map(tuple, mix(spark, odd_docs(spark)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_sources_come_near_their_targets(spark):
    rows = []
    for s, n in (("big", 600), ("mid", 120), ("small", 60), ("tiny", 10), (None, 40)):
        rows += [(len(rows) + k, prose(len(rows) + k, 20 + k % 90), "en", s, 1) for k in range(n)]
    got = mix(spark, spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    source = {r[0]: r[3] for r in rows}
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in got:
        taken[source[r.doc_id]] += r.taken
        size[source[r.doc_id]] += r.size
        target[source[r.doc_id]] = r.target
        assert r.taken <= 3 * r.size
    assert target == pytest.approx(targets(size))
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s in target:
        assert abs(taken[s] - target[s]) <= max(0.01 * target[s], 4 * 64)


def test_small_sources_come_near_their_own_targets(spark):
    """Sources of some words to some thousands beside a large one: each is near
    its own target, by its own size."""
    rows, small = [], (5, 30, 100, 500, 1300, 3000)
    for s, n in [("a", 60000), *((f"b{k:02}", small[k % len(small)]) for k in range(36))]:
        while n:
            size = min(n, 10 if s < "b" else 25) if n < 2000 else min(n, 400)
            rows.append((len(rows), " ".join(["w"] * size), "en", s, 1))
            n -= size
    got = mix(spark, spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    source = {r[0]: r[3] for r in rows}
    taken, target = defaultdict(int), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s in target:
        size = sum(len(r[1].split()) for r in rows if r[3] == s)
        assert abs(taken[s] - target[s]) <= 4 * max(1, min(64, size / 1024)), (s, taken[s], target[s])


def test_blocks_do_not_grow_with_the_corpus(spark):
    """13.5M slots: a source that is due a few of them gets these few."""
    from pyspark.sql import functions as F

    from quire.llm.source_mix import schedule

    due = [(0, 1.2e7), (1, 3000.0), (2, 15.0), (3, 1.5e6)]
    got = schedule(spark, spark.createDataFrame(due, "i int, want double")).groupBy("i").agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == sum(w for _, w in due)
    assert all(abs({r.i: r.n for r in got}[i] - w) <= 4 for i, w in due)
