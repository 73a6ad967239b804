"""Quality classifier and quality rules: contract columns by brute force,
held-out accuracy on labelled rows, odd rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

from conftest import SF_MID
from test_support import SCHEMA, empty_docs, key, odd_docs, odd_rows, prose, words

from quire.llm import queries
from quire.llm import quality_classifier as Q
from quire.llm.quality_rules import quality_rules, train


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(spark):
    got = queries.op2_quality_classifier(spark, SF_MID).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(label[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in label]
    good = [p for y, p in held if y == 1]
    bad = [p for y, p in held if y == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_classifier_measures_each_text_once(spark):
    from quire.session import scratch_path

    folder = scratch_path(spark, "op2")
    docs, labels = odd_docs(spark), labels_of(spark, [(4, 1, 0), (8, 0, 0), (11, 1, 0), (9, 0, 0)])
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    got = queries.op2_quality_classifier(spark, folder)
    # learning and scoring read the statistics that one pass over the texts wrote
    assert not [f for f in got.inputFiles() if "documents.parquet" in f]
    model = Q.learn(spark, docs, labels)
    want = sorted((key(r.doc_id), r.score) for r in Q.quality_scores(spark, docs, model).collect())
    rows = sorted((key(r.doc_id), r.score) for r in got.collect())
    assert [k for k, _ in rows] == [k for k, _ in want] and len(rows) == len(odd_rows())
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(rows, want))


def test_classifier_of_no_rows(spark):
    measured = Q.measure(empty_docs(spark))
    assert measured.columns == [*empty_docs(spark).columns, "stats"]
    model = Q.learn(spark, measured, labels_of(spark), stats_col="stats")
    assert Q.quality_scores(spark, measured, model, stats_col="stats").collect() == []


def test_classifier_odd_rows(spark):
    docs = odd_docs(spark)
    for rows in ([], [(4, 1, 0), (8, 1, 0)], [(4, 1, 0), (8, 0, 0), (11, 1, 0), (9, 0, 0), (9, 1, 0), (None, 1, 0), (7, None, 0)]):
        model = Q.learn(spark, docs, labels_of(spark, rows))
        got = Q.quality_scores(spark, docs, model, score_col="q").collect()
        assert sorted(key(r.doc_id) for r in got) == sorted(key(r[0]) for r in odd_rows())
        assert all(0 <= r.q <= 1 and r.t == "t" for r in got)
        same = {r.q for r in got if r.doc_id in (4, 5)}
        assert len(same) == 1
        assert Q.quality_scores(spark, empty_docs(spark), model).collect() == []


def brute(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), failed


def test_rules(spark):
    docs = odd_docs(spark)
    got = quality_rules(spark, docs, labels_of(spark, [(4, 1, 0), (8, 0, 0), (11, 1, 0), (9, 0, 0)])).collect()
    want = sorted((key(r[0]), *brute(r[1])) for r in odd_rows())
    assert sorted((key(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    none = train(spark, docs, labels_of(spark))
    assert len(quality_rules(spark, docs, labels_of(spark), model=none).collect()) == len(odd_rows())
    assert quality_rules(spark, empty_docs(spark), labels_of(spark), model=none).collect() == []


def test_rules_on_labelled_rows(spark):
    got = queries.op10_quality_rules(spark, SF_MID).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    for r in got[:300]:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text[r.doc_id])
    good = [r.kept for r in got if label.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in got if label.get(r.doc_id) == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_a_text_scores_alike_beside_any_neighbours():
    """n-grams end with their text: the same slots alone and between others."""
    import numpy as np
    import pyarrow as pa

    from quire.llm import quality_rules as R
    from quire.llm.textarrays import Texts

    w = np.random.default_rng(5).normal(0, 1, (R.KINDS, 1 << R.BITS)).astype(np.float32)
    for text in ("some words of a text", "ab", "é", "one", "", " ", "abcde f"):
        alone = R.margins(Texts(pa.array([text])), w, 0.0)[0]
        for left, right in (("", ""), ("before it", "after"), ("x", "y"), ("", "other words here"), ("more", "")):
            got = R.margins(Texts(pa.array([left, text, right])), w, 0.0)[1]
            assert got == alone, (text, left, right)
        y = np.array([0, 1] * 10)
        rows = [text + " good" if k else text + " bad" for k in y]
        fitted = [R.fit(pa.array(rows + [tail]), np.append(y, 0), np.arange(21) >= 20).weights for tail in ("x", "quite other words")]
        assert np.array_equal(*fitted)


def test_texts_of_one_id_give_one_model(spark):
    """The sample's text of an id doesn't hang on partitions or order."""
    rows = [(k % 40, prose(k, 60 + k), "en", "a", 1) for k in range(120)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality long")
    one, two = (train(spark, spark.createDataFrame(r, SCHEMA).repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 5)))
    assert abs(one.weights - two.weights).max() < 1e-5 and abs(one.bias - two.bias) < 1e-5
