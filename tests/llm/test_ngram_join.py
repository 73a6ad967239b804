from __future__ import annotations

from test_support import SCHEMA, empty_docs, key, odd_docs, odd_rows, prose, words

from quire.llm import ngram_join
from quire.llm.ngram_join import least_matches, similar_documents


def brute(rows):
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set()))
    n = len(rows)
    link = [[j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    low = [key(r[0]) for r in rows]
    for _ in range(n):
        low = [min([low[i]] + [low[j] for j in link[i]]) for i in range(n)]
    return sorted((key(r[0]), low[i], len(link[i])) for i, r in enumerate(rows))


def check(spark, rows, docs):
    got = similar_documents(spark, docs).collect()
    assert sorted((key(r.doc_id), key(r.class_id), r.n_links) for r in got) == brute(rows)
    heads = [r for r in got if r.leads]
    assert all(r.class_id == r.doc_id for r in heads)
    with_words = [r for r in got if r.n_links or r.leads]
    assert len({key(r.class_id) for r in with_words}) <= len(heads)


def test_odd_rows(spark):
    check(spark, odd_rows(), odd_docs(spark))


def near_copies(n):
    base = words(prose(1, 120))
    rows = []
    for k in range(n):
        w = list(base)
        for j in range(k % 7):
            w[(17 * k + 23 * j) % 120] = f"edit{k}x{j}"
        rows.append((k, " ".join(w), "en", "a", 1))
    return rows + [(1000 + k, prose(2000 + k, 60), "en", "b", 1) for k in range(30)]


def test_large_group_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_CLASSES", 16)
    rows = near_copies(90)
    check(spark, rows, spark.createDataFrame(rows, SCHEMA))


def test_rows_are_carried_and_empty_table(spark):
    got = similar_documents(spark, odd_docs(spark), carry=True)
    assert got.select("row.*").columns == odd_docs(spark).columns
    assert similar_documents(spark, empty_docs(spark)).collect() == []


def test_pruning_keeps_similar_pairs():
    least = least_matches(0.8, 1e-8)
    assert least == sorted(least) and least[0] < 0.3 * 16 and 0.4 * 128 < least[-1] < 0.8 * 128
