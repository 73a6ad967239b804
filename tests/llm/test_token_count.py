from __future__ import annotations

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from test_support import empty_docs, key, odd_docs, odd_rows

from quire.llm.token_count import counter, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_against_library(spark):
    got = token_counts(odd_docs(spark), PATH).collect()
    want = [(key(r[0]), len((r[1] or "").encode()), len(LIBRARY.encode(r[1] or ""))) for r in odd_rows()]
    assert sorted((key(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted(want)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts(empty_docs(spark), PATH).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60) | st.text(alphabet="ab ▁\n\r;(){}é", max_size=60))
def test_any_text(text):
    assert counter(PATH).count(text) == len(LIBRARY.encode(text))
