from __future__ import annotations

import numpy as np
import pytest

from quire.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def rows_of(n=500, dim=16):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(n, dim))
    v[40:120] = v[40] + 0.03 * rng.normal(size=(80, dim))  # one dense cluster
    v[200:204] = v[200]  # copies
    v[210:214] = v[210] * np.array([[1], [2], [3], [4]])  # the same direction
    rows = [(int(i), [float(x) for x in np.float32(r)], 0, "x") for i, r in enumerate(v)]
    other = rng.normal(size=(60, 5)).astype(np.float32)
    other[:20] = other[0] + 0.02 * rng.normal(size=(20, 5))  # a cluster of shorter vectors
    rows += [(n + 100 + i, [float(x) for x in r], 0, "x") for i, r in enumerate(other)]
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] * dim, [1.0, 2.0], [1.0, 2.0], [2.0, 4.1], [2.0, -1.0], [-3.0], [0.5], [7.0]]
    return rows + [(n + i, e, 0, "x") for i, e in enumerate(odd)]


def brute(rows):
    good = [r for r in rows if r[1] and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    link = {r[0]: [] for r in rows}
    for a in good:
        for b in good:
            if a[0] != b[0] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    link[a[0]].append(b[0])
    low = {i: i for i in link}
    for _ in range(20):
        low = {i: min([low[i]] + [low[j] for j in link[i]]) for i in link}
    return sorted((i, len(link[i]), low[i], low[i] == i) for i in link)


@pytest.mark.parametrize("shard,tile", [(16384, 2048), (60, 24)])
def test_against_brute_force(spark, monkeypatch, shard, tile):
    monkeypatch.setattr(E, "SHARD", shard)
    monkeypatch.setattr(E, "TILE", tile)
    rows = rows_of()
    got = E.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = brute(rows)
    have = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got)
    assert len(have) == len(want)
    found, true = sum(r[1] for r in have), sum(r[1] for r in want)
    assert found >= 0.99 * true and all(a[1] <= b[1] for a, b in zip(have, want, strict=True))
    if shard > 1000:
        assert have == want


def test_all_pairs_where_the_index_misses(spark, monkeypatch):
    """With a target that no index reaches, the exact way gives every link."""
    monkeypatch.setattr(E, "TARGET", 1.1)
    monkeypatch.setattr(E, "TRIES", 1)
    monkeypatch.setattr(E, "TILE", 100)
    rows = rows_of()
    got = E.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute(rows)


def test_recall_counts_each_query_alike(spark):
    """A lost pair beside a large group that was found."""
    v = [[1.0, 0.001 * i] for i in range(100)] + [[0.0, 1.0], [0.001, 1.0]]
    nodes = spark.createDataFrame([(i, 1, x) for i, x in enumerate(v)], "node long, weight long, v array<double>")
    told = spark.createDataFrame([(i, 99, 0) for i in range(100)] + [(100, 0, 100), (101, 0, 101)], "node long, links long, to long")
    assert abs(E._recall(nodes, told, nodes.collect(), 0.95) - 100 / 102) < 1e-9


def test_empty_table(spark):
    assert E.near_duplicates(spark, spark.createDataFrame([], SCHEMA)).collect() == []
