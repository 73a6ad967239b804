from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from test_support import empty_docs, key, odd_docs, odd_rows, prose
from tokenizers import Tokenizer

from quire.llm.bpe_codec import Codec, Lexicon, encode

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = Codec(PATH, None)


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def test_against_library(spark):
    got = encode(spark, odd_docs(spark), PATH, carry=["doc_id"]).collect()
    want = []
    for r in odd_rows():
        ids, back = library(r[1] or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((key(r[0]), len(ids), raw, hashlib.sha256(raw).hexdigest(), back, hashlib.sha256(back.encode()).hexdigest()))
    assert sorted((key(r.doc_id), r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded, r.decoded_sha256) for r in got) == sorted(want)
    assert encode(spark, empty_docs(spark), PATH).collect() == []
    all_columns = encode(spark, odd_docs(spark), PATH, outputs=("n_tokens",)).columns
    assert sorted(all_columns) == sorted(odd_docs(spark).columns)  # n_tokens is replaced


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=50) | st.text(alphabet="aB'sre <|endoftx>9\n\x1c ΣİÅé", max_size=50))
def test_any_text(text):
    ids, back = library(text)
    packed = OWN.encode([text])
    assert np.frombuffer(packed[0], "<u4").tolist() == ids
    assert OWN.decode(packed)[0] == back


def test_lexicon_is_minimal_and_exact(tmp_path):
    found = sorted({w for k in range(40) for w in prose(k, 50).split()})
    lex = Lexicon.compile({w.encode(): OWN.bpe.encode_word(w) for w in found})
    lex.save(str(tmp_path / "lexicon"))
    lex = Lexicon.open(str(tmp_path / "lexicon"))
    at = lex.find([w.encode() for w in found])
    assert sorted(at.tolist()) == list(range(len(found)))
    for w, k in zip(found, at, strict=True):
        assert lex.ids[lex.id_at[k] : lex.id_at[k + 1]].tolist() == OWN.bpe.encode_word(w)
    missing = ["", "zz", found[0] + "q", found[0][:-1] + "\x00"]
    assert (lex.find([w.encode() for w in missing]) == -1).all()
    # minimal: no two states with the same right language
    edges: dict[int, list] = {}
    for k, to in zip(lex.keys.tolist(), lex.to.tolist(), strict=True):
        edges.setdefault(k >> 8, []).append((k & 255, to))
    signs = [(int(lex.final[s]), tuple(edges.get(s, ()))) for s in range(len(lex.final))]
    assert len(set(signs)) == len(signs)
    assert (Lexicon.compile({}).find([b"a"]) == -1).all()
