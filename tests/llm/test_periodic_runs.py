from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from test_support import empty_docs, key, odd_docs, odd_rows, prose, words

from quire.llm import periodic_runs as P
from quire.llm.queries import op13_periodic_runs
from quire.llm.textarrays import Texts, mix64


def brute(w, min_length=6, times=4):
    """Every maximal run of a list of words, by its definition."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if length >= max(min_length, times * q):
                r = w[s : s + length]
                if not any(all(r[j] == r[j + d] for j in range(length - d)) for d in range(1, q)):
                    out.append((s, length, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapsed(w, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("min_length,times", [(6, 4), (2, 2), (5, 3), (12, 4)])
def test_small_alphabets(min_length, times):
    rng = random.Random(min_length * 10 + times)
    for _ in range(150):
        docs = []
        for _ in range(rng.randrange(1, 6)):
            w = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(0, 60))]
            if rng.random() < 0.6 and w:
                w += w[rng.randrange(len(w)) :] * rng.randrange(0, 7)
            docs.append(w)
        bounds = np.cumsum([0] + [len(w) for w in docs])
        names = mix64(np.array([x for w in docs for x in w], np.uint64) + np.uint64(5))
        got = [tuple(r) for r in P.find_runs(names, bounds, min_length, times).tolist()]
        want = [(s + b, length, q) for w, b in zip(docs, bounds, strict=False) for s, length, q in brute(w, min_length, times)]
        assert got == sorted(want, key=lambda x: (x[0], x[2])), docs


def test_many_positions_in_one_class():
    """Sets of more than one block, inserted at the end and in the middle."""
    w = (["a", "b"] * 4000 + ["c"] + ["a"] * 3000) * 2
    t = Texts(__import__("pyarrow").array([" ".join(w)]))
    got = [tuple(r) for r in P.find_runs(t.names, t.bounds).tolist()]
    assert got == [(0, 8000, 2), (8001, 3001, 1), (11001, 8000, 2), (19002, 3000, 1)]
    p = P.Positions(list(range(0, 20000, 2)))
    order = list(range(1, 20001, 2))
    random.Random(1).shuffle(order)
    have = set(range(0, 20000, 2))
    for x in order:
        before, after = p.add(x)
        assert before == x - 1 if x - 1 in have else True
        have.add(x)
        assert after > x > before and after in have | {P.NONE}
    assert list(p) == list(range(20000)) and len(p) == 20000


def test_operator_on_odd_rows(spark):
    got = P.periodic_runs(spark, odd_docs(spark)).collect()
    want = []
    for i, text, *_ in odd_rows():
        w = words(text)
        runs = brute(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        want.append((key(i), len(w), runs, best, collapsed(w, runs)))
    have = [(key(r.doc_id), r.n_words, [tuple(x) for x in r.runs], (r.start, r.length, r.period), r.kept) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert P.periodic_runs(spark, empty_docs(spark)).collect() == []


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_against_brute_force(spark, tmp_path):
    rows = odd_rows() + [(i, prose(i, 20 + i % 90), "en", "a", 0) for i in range(20, 160)]
    spark.createDataFrame(rows, odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars").schema).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want, planted_runs = [], 0
    for i, text, *_ in rows:
        w = planted(i, words(text))
        runs = brute(w)
        planted_runs += bool(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        want.append((key(i), len(runs), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(collapsed(w, runs))))
    got = op13_periodic_runs(spark, str(tmp_path)).collect()
    cols = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted(((key(r.doc_id), *[r[c] for c in cols]) for r in got), key=str) == sorted(want, key=str)
    assert planted_runs > 10
