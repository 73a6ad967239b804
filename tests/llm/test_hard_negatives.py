from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import hard_negatives as H
from quire.llm.queries import op12_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, score string"


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 64, 33), (40, 35, 41), (100, 17, 70), (5, 0, 4), (64, 64, 64)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(m * n)
    a, b = rng.integers(-(2**24), 2**24, (m, k)), rng.integers(-(2**24), 2**24, (k, n))
    assert (H.strassen(a, b) == a @ b).all()
    big = H.scores(a * 2**30, b.T * 2**30)
    want = np.clip((a.astype(object) * 2**30) @ (b.astype(object) * 2**30), -H.LIMIT, H.LIMIT)
    assert big.dtype == np.int64 and (big == want).all()


def test_best_breaks_ties_by_column():
    t = np.array([[5, 7, 7, H.NONE, 7], [H.NONE] * 5, [1, 1, 1, 1, 1]])
    i, j = H.best(t, 3)
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 1), (0, 2), (0, 4), (2, 0), (2, 1), (2, 2)]


def brute(rows, every):
    long = lambda x: min(max(math.floor(256 * x), -(2**63)), 2**63 - 1)
    use = [
        (i, label, [long(x) for x in v]) for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    dot = lambda a, b: min(max(sum(x * y for x, y in zip(a, b, strict=True)), -H.LIMIT), H.LIMIT)
    out = []
    for k, (i, label, v) in enumerate(use):
        if i % every:
            continue
        s = [(dot(v, w), j, m) for n, (j, m, w) in enumerate(use) if n != k and len(w) == len(v)]
        s.sort(key=lambda x: (-x[0], x[1]))
        for ps, p, _ in [x for x in s if x[2] == label][:5]:
            ok = [(ns, j) for ns, j, m in s if m != label and 50 * ps <= 100 * ns <= 95 * ps]
            out += [(i, p, r + 1, j, ps, ns) for r, (ns, j) in enumerate(ok[:3])]
    return sorted(out)


def odd_vectors():
    rng = random.Random(4)
    rows = []
    for i in range(260):
        base = [rng.gauss(0, 1) for _ in range(20)]
        rows.append((i, [x / 4 + (i % 5 == k) for k, x in enumerate(base)], rng.choice([0, 1, 2, 2, 2, None])))
    rows += [rows[10], rows[10], rows[20], (10, rows[30][1], 1)]  # repeated rows and a repeated id
    rows += [(300, None, 1), (301, [], 1), (305, [], 2), (310, [0.0] * 20, 1), (315, [0.0] * 20, 2), (320, [float("nan")] * 20, 1)]
    rows += [(325, [float("inf")] * 20, 2), (330, [None] * 20, 1), (None, rows[2][1], 1), (335, [1.0, 2.0], 0), (340, [1.0, 2.5], 0), (341, [1.0, 1.5], 1)]
    rows += [(345, [1e30] * 20, 1), (346, [1e30] * 20, 1), (347, [3e7] * 20, 2), (350, [1.0] * 20, 2), (351, [1.0] * 20, 2), (352, [0.9] * 20, 1)]
    return rows


@pytest.mark.parametrize("tile", [(4096, 8192), (7, 30)])
def test_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(H, "ANCHORS", tile[0])
    monkeypatch.setattr(H, "CANDIDATES", tile[1])
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3).withColumn("no", F.lit(1)).withColumn("d", F.lit(1))
    got = H.mine(spark, df, F.col("vec_id") % 5 == 0).collect()
    want = brute(rows, 5)
    assert sorted(tuple(r) for r in got) == want and len(want) > 200


def test_empty_and_unfit_tables(spark):
    rows = [(0, [1.0], 1, 1, "x"), (50, [2.0], 2, 1, "x")]
    for df in (spark.createDataFrame([], SCHEMA), spark.createDataFrame(rows, SCHEMA)):
        assert H.mine(spark, df, F.col("vec_id") % 50 == 0).collect() == []


def test_query_moves_labels(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0.2, 1) for _ in range(8)], rng.randrange(10)) for i in range(400)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, np.array(v, np.float32).astype(float).tolist(), (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    got = op12_hard_negatives(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == brute(moved, 50)
