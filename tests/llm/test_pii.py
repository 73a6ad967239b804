from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F
from test_support import SCHEMA, empty_docs, key, odd_docs

from quire.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = [True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 13 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15][k]
            if ok:
                out.append((k, m.start(), m.end()))
    return out


TEXTS = [
    "a@b.co@d.e", "a@b.c_x@d.e x", "1.2.3.4.5.6.7.8 999.1.1.1", "+1 (706) 555-3138 é\U0001f600 4644348398010899 4644 3483 9801 0899",
    "+12 34", "0001.0002.000255.256 1.02.3.0004", "+1234567890123456", "tel 555-123-4567 and (706) 555-3138", "bob (at) mail (dot) com",
    "1" * 9000, "-1-2 3  4", "4644348398010899-4644348398010899", "++1 2345678 90", "a" * 9000 + " x@y", "@@a@.b.c", "%+-@a-.b- c@d.e.f.",
    "", None, "4111 1111 1111 1111 4111111111111111 4111111111111112", "mail me: first.last@mail7.example.com or 10.0.0.1:80",
    "+49 30 1234567, +49 (30) 123 45 67 8", "1.2.3", "5555-5555-5555-4444\n5555 5555\t5555 4444",
]


def test_base_spans_and_overlaps(spark):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS * 3)]
    got = pii.find_spans(spark, spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[r.doc_id % len(TEXTS)]
        own = [tuple(x) for x in r.base]
        assert own == base(text), text and text[:40]
        spans = [tuple(x) for x in r.spans]
        assert set(own) <= set(spans) and spans == sorted(spans)
        added = sorted((s, e) for k, s, e in spans if (k, s, e) not in own)
        for s, e in added:
            assert e <= len(text) and not any(s < y and x < e for _, x, y in own)
        assert all(a[1] <= b[0] for a, b in zip(added, added[1:], strict=False))


def test_redaction_and_odd_rows(spark):
    rows = [(1, "x a@b.co, +1 (706) 555-3138, 4644348398010899 é", "en", "a", 1), (2, None, "en", "a", 1)]
    got = pii.find_spans(spark, spark.createDataFrame(rows, SCHEMA), carry=True)
    out = {r[0]: r[1] for r in got.select("doc_id", pii.redacted(F.col("row.text"), F.col("spans"))).collect()}
    assert out[1].startswith("x [EMAIL], [PHONE]") and out[1].endswith(" é") and not re.search("[0-9]", out[1]) and out[2] is None
    odd = pii.find_spans(spark, odd_docs(spark), carry=True)
    assert sorted(key(r.doc_id) for r in odd.collect()) == sorted(key(r.doc_id) for r in odd_docs(spark).collect())
    assert pii.find_spans(spark, empty_docs(spark)).collect() == []


def test_boosting_adds_spans_that_the_base_misses(spark):
    rows = [(k, f"word +1 (706) 555-{3000 + k} word 464434839801{k % 10}899 word", "en", "a", 1) for k in range(300)]
    rows = [(k, t.replace("464434839801%d899" % (k % 10), "4644348398010899" if k % 3 else "4644348398010890"), "en", "a", 1) for k, t, *_ in rows]
    rows.append((1000, "both 4644348398010899 4644348398010899 and +1 (706) 555-3138 190.", "en", "a", 1))
    got = {r.doc_id: r for r in pii.find_spans(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    text, last = rows[-1][1], got[1000]
    found = {(pii.KINDS[k], text[s:e]) for k, s, e in last.spans}
    assert all(pii.KINDS[x.k] == "phone" for x in last.base)  # the cards run together, and are refused as one
    assert ("card", "4644348398010899") in found and len(found) >= 2
    refused = [k for k in range(300) if not k % 3]
    assert not any(pii.KINDS[x.k] == "card" for k in refused for x in got[k].spans)


def test_no_python_on_the_path(spark):
    made = pii.proposals(spark.createDataFrame([(1, "a@b.co", "en", "a", 1)], SCHEMA), "doc_id", "text", False)
    plan = made._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_texts_of_very_many_matches(spark):
    """Time grows with the matches, not with their square."""
    parts = [f"u{i}@mail{i}.example.org, 4644 3483 9801 0899; 10.0.{i % 256}.{i % 300} é\U0001f600 +49 30 12{i:05d}\n" for i in range(5000)]
    text = "".join(parts)
    rows = [(1, text, "en", "a", 1), (2, "4644348398010899 " * 3000, "en", "a", 1), (3, "555-123-4567 x " * 3000, "en", "a", 1)]
    start = time.time()
    got = pii.find_spans(spark, spark.createDataFrame(rows, SCHEMA), carry=True).withColumn("red", pii.redacted(F.col("row.text"), F.col("spans")))
    got = {r.doc_id: r for r in got.collect()}
    assert time.time() - start < 90
    for i, t, *_ in rows:
        spans = sorted((s, e, k) for k, s, e in got[i].spans)
        assert sorted((k, s, e) for k, s, e in got[i].base) == base(t)
        at, out = 0, []
        for s, e, k in spans:
            if s >= at:
                out += [t[at:s], f"[{pii.KINDS[k].upper()}]"]
            at = max(at, e)
        assert got[i].red == "".join(out) + t[at:]
    assert len(got[1].base) > 19000


def test_choice_of_proposals(spark):
    """Those free of base spans, best score first, as by definition."""
    rng = random.Random(5)
    for n in (0, 1, 2, 7, 60):
        base_rows = [(k, s, s + rng.randint(1, 9)) for k in range(4) for s in sorted(rng.sample(range(400), n // 8))]
        more = [(s, s + rng.randint(1, 20), rng.randint(0, 3), rng.choice([0.5, 1.0, rng.random()])) for s in rng.sample(range(400), n)]
        df = spark.createDataFrame([(base_rows, more)], "b array<struct<k:int,s:int,e:int>>, m array<struct<s:int,e:int,k:int,z:double>>")
        r = df.select(pii._free(F.col("b"), F.col("m")).alias("f"), pii._best(F.sort_array("m")).alias("t")).first()
        meets = lambda a, b: a[0] < b[1] and b[0] < a[1]
        assert [tuple(x) for x in r.f] == sorted(x for x in more if not any(meets(x, b[1:]) for b in base_rows))
        taken = []
        for z, k, s, e in sorted((-z, k, s, e) for s, e, k, z in more):
            if not any(meets((s, e), y[1:]) for y in taken):
                taken.append((k, s, e))
        assert sorted(map(tuple, r.t)) == sorted(taken)
