from __future__ import annotations

import re

import pytest
from test_support import empty_docs, key, odd_docs, odd_rows, prose
from pyspark.sql import functions as F

from quire.llm.decontamination import contamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(UPPER))


def brute(docs, items, width):
    windows = []
    for item, text in items:
        w = words(text)
        m = min(len(w), width)
        windows += [(item, tuple(w[i : i + m])) for i in range(len(w) - m + 1) if m]
    out = []
    for doc, text in docs:
        w = words(text)
        hit, named = set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i : i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    named.add(item)
        out.append((key(doc), len(w), len(hit), sorted(str(i) for i in named if i is not None)))
    return sorted(out)


ITEMS = [
    (1, prose(6, 30)), (2, prose(900, 60)), (3, None), (4, " .,; "), (5, "only three"), (6, "A"), (7, "again again again again"),
    (10, prose(4, 40).upper()), (10, prose(11, 12)), (None, prose(11, 20)), (11, "é ÀB"), (12, "a b a b a b a b a b a b"), (2, prose(900, 60)),
]


@pytest.mark.parametrize("width,k", [(10, 5), (4, 2), (13, 5)])
def test_against_brute_force(spark, width, k):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").repartition(2)
    got = contamination(spark, odd_docs(spark), items, width, k).collect()
    want = brute([r[:2] for r in odd_rows()], ITEMS, width)
    assert sorted((key(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got) == want
    for r in got:
        flat = [x for s in r.spans for x in s]
        assert all(a < b for a, b in zip(flat, flat[1:], strict=False))  # apart, not even touching
        assert sum(s.end - s.start for s in r.spans) == r.n_hit


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination(spark, empty_docs(spark), items).collect() == []
    none = contamination(spark, odd_docs(spark), items.limit(0)).collect()
    assert {(r.n_hit, len(r["items"])) for r in none} == {(0, 0)} and len(none) == len(odd_rows())


def test_long_text_and_common_window(spark):
    """A passage in every document, once in a text of 60,000 words."""
    passage = prose(77, 10)
    rows = [(i, prose(1000 + i, 20) + " " + passage) for i in range(200)] + [(500, prose(5, 60000) + " " + passage + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(i, passage) for i in range(50)], "item_id long, text string")
    got = contamination(spark, docs, items).collect()
    assert {(r.n_hit, len(r["items"])) for r in got} == {(10, 50)} and len(got) == 201


def test_shared_spans_are_never_missed(spark):
    """A shared span of exactly the width, at every distance from the text's ends."""
    item = prose(3, 25)
    w = item.split()
    rows = [(100 * a + b, " ".join(prose(40 + b, b).split() + w[a : a + 10] + ["zz"])) for a in range(16) for b in range(8)]
    got = contamination(spark, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r.n_hit for r in got.collect()} == {10}


def test_no_python_on_the_path(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = contamination(spark, odd_docs(spark).withColumn("items", F.lit(1)), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
