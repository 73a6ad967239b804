from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from test_support import empty_docs, key, odd_docs, odd_rows, prose, words

from quire.llm.substring_dedup import anchors, dedup_substrings
from quire.llm.textarrays import Texts


def brute(texts, width):
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in all_words for i in range(len(w) - width + 1))
    out = []
    for w in all_words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), int(gone.sum()), kept))
    return out


@pytest.mark.parametrize("width", [35, 4])
def test_against_brute_force(spark, width):
    rows = odd_rows()
    got = dedup_substrings(spark, odd_docs(spark), width).collect()
    want = [(key(r[0]), *b) for r, b in zip(rows, brute([r[1] for r in rows], width), strict=True)]
    assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == sorted(want)
    digests = dedup_substrings(spark, odd_docs(spark), width, kept_as="sha256").collect()
    assert sorted(r.kept for r in digests) == sorted(hashlib.sha256(w[3].encode()).hexdigest() for w in want)


def test_empty_table(spark):
    assert dedup_substrings(spark, empty_docs(spark)).collect() == []


def test_equal_windows_have_equal_anchors():
    import pyarrow as pa

    shared = prose(1, 40)
    texts = [f"{prose(k, 3 + k)} {shared} {prose(50 + k, 9)}" for k in range(2, 30)] + ["b a " + "a a b " * 30]
    t = Texts(pa.array(texts))
    p, a = anchors(t.names, t.bounds, 35)
    group = np.searchsorted(p, np.arange(len(t.names)), side="right") - 1
    by_window: dict[tuple, set] = {}
    for d in range(len(texts)):
        for i in range(t.bounds[d], t.bounds[d + 1] - 34):
            by_window.setdefault(tuple(t.names[i : i + 35].tolist()), set()).add(int(a[group[i]]))
    assert all(len(s) == 1 for s in by_window.values())
