"""Stages one after another on a small folder, each checked on its own input."""

from __future__ import annotations

import re

import corpus_pipeline as P
import numpy as np
import public_tokenizers
from conftest import SF_SMALL
from test_support import empty_docs, key, odd_docs, words
from tokenizers import Tokenizer

from quire.llm import queries
from quire.session import scratch_path


def written(spark, df):
    path = scratch_path(spark, "test-stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    names = docs.columns
    # 1: what goes is mostly labelled bad, what stays good
    kept = written(spark, P.quality(spark, docs, SF_SMALL))
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    good = [i in ids for i, y in label.items() if y == 1]
    bad = [i in ids for i, y in label.items() if y == 0]
    assert kept.columns == names and sum(good) >= 0.9 * len(good) and sum(bad) <= 0.2 * len(bad)
    # 2: no pair of near duplicates is left, and nothing else went
    single = written(spark, P.distinct(spark, kept, SF_SMALL))
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [words(t)] for i in range(len(w) - 4)} or {tuple(words(t))}
    before = [(r.doc_id, shingles(r.text)) for r in kept.collect()]
    after = [r.doc_id for r in single.collect()]
    near = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    low = {i: i for i, _ in before}
    links = [(i, j) for i, a in before for j, b in before if i < j and near(a, b)]
    for _ in range(8):
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
    assert single.columns == names and sorted(after) == sorted(set(low.values()))
    # 3: no address is left, texts without digits and signs are as before
    clean = written(spark, P.private(spark, single, SF_SMALL))
    text = {r.doc_id: r.text for r in single.collect()}
    assert clean.columns == names and clean.count() == single.count()
    for r in clean.collect():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text) and r.n_chars == len(r.text)
        if not re.search("[0-9@]", text[r.doc_id]):
            assert r.text == text[r.doc_id]
    # 4: every document at most three times
    mixed = written(spark, P.mix(spark, clean, SF_SMALL))
    times = {r[0]: r[1] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == names and max(times.values()) <= 3 and set(times) <= set(after)
    # 5: ids and digests of the public library
    library = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    out = P.encode(spark, mixed, SF_SMALL).collect()
    final = {r.doc_id: r.text for r in mixed.collect()}
    assert len(out) == mixed.count()
    for r in out[:80]:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(final[r.doc_id], add_special_tokens=False).ids


def test_odd_rows_go_through(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        names = docs.columns
        for _, stage in P.STAGES[1:-1]:
            docs = written(spark, stage(spark, docs, SF_SMALL))
            assert docs.columns == names
        P.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    ids = [key(r.doc_id) for r in P.distinct(spark, odd_docs(spark), SF_SMALL).collect()]
    assert ids.count(5) == 0 and ids.count(4) == 1 and {1, 2, 3} <= set(ids)


def test_queries_are_registered():
    import __spark_entry__ as E

    found = E.queries()
    assert {*queries.QUERIES, "pipeline"} <= set(found)
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in P.STAGES] == ["quality", "distinct", "private", "mix", "encode"]
