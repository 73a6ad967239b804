"""Byte-pair encoding and decoding through a minimal acyclic word lexicon.

The corpus' frequent words (blank-separated, counted over all documents) are
encoded once by exact merging and compiled into a minimal acyclic automaton
over their bytes: states with equal suffixes are shared, and each transition
carries how many words come before it, so a walk yields a word's number and by
that its ids. The automaton is a few flat arrays in one file, sent by Spark to
each executor and memory-mapped there by all its Python workers. The words of
a batch walk it together, one byte per step; a word that isn't in it is merged
exactly, and remembered in a bounded memo.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import struct
import tempfile
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.textarrays import spare, text_column
from quire.session import write_scratch

LEXICON_WORDS = 1 << 16  # bound of the lexicon; rarer words are merged
LONGEST = 32  # bytes of a word in the lexicon
MEMO_ENTRIES = 300_000  # bound of each memo of a Python worker
NO_MERGE, ID_MASK = 1 << 60, (1 << 20) - 1


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself if
    printable, else the next code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


UNICODE_BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# Code points up to U+017F but U+0130, whose lower case is two: composed, so
# normal as they are, and of the same classes in every Unicode version in use.
LATIN = re.compile("[\x00-\u012f\u0131-\u017f]*").fullmatch
LATIN_LETTERS = "a-zªµºß-öø-ſ"  # of lower-cased text
LATIN_NUMBERS = "0-9²³¹¼½¾"


class WordBpe:
    """Exact encoder of a blank-free word, from a public vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.tail = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split
        steps = spec["normalizer"]["normalizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("another normaliser than NFC, blanks, lower case")
        # Unicode tables differ between versions, so words beyond Latin letters go
        # through the public library's own normaliser and splitter; merging is ours.
        library = Tokenizer.from_file(path)
        self.normal, self.pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for name, inside in ((r"\p{L}", LATIN_LETTERS), (r"\p{N}", LATIN_NUMBERS), (r"\s", UNICODE_BLANKS)):
            pattern = pattern.replace(name, inside)  # they stand inside brackets only
        self.split = re.compile(pattern).findall
        self.letters = byte_letters()
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.merges: dict[int, int] = {}  # pair -> rank and merged id in one integer, so they sort by rank
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a] << 20 | self.vocab[b]] = rank << 20 | self.vocab[a + b]
        self.piece_memo: dict[str, list[int]] = {}
        self.first = [self.vocab[c] for c in self.letters]
        self.final = [self.vocab[c + self.tail] for c in self.letters]

    def merged(self, ids: list[int]) -> list[int]:
        """Symbols with the lowest-ranked adjacent pair, leftmost first, merged
        until none is left."""
        if len(ids) > 48:
            return self._merged_long(ids)
        get = self.merges.get
        ranks = [get(a << 20 | b, NO_MERGE) for a, b in zip(ids, ids[1:])]  # noqa: B905
        while ranks and (best := min(ranks)) != NO_MERGE:
            i = ranks.index(best)
            new = best & ID_MASK
            ids[i] = new
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(new << 20 | ids[i + 1], NO_MERGE)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | new, NO_MERGE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        get, n = self.merges.get, len(ids)
        nxt, prv = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j, new = nxt[i], m & ID_MASK
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            k = nxt[i] = nxt[j]
            if k >= 0:
                prv[k] = i
                if (m := get(new << 20 | ids[k])) is not None:
                    heapq.heappush(heap, (m, i, new, ids[k]))
            if (h := prv[i]) >= 0 and (m := get(ids[h] << 20 | new)) is not None:
                heapq.heappush(heap, (m, h, ids[h], new))
        return [x for x in ids if x >= 0]

    def encode_word(self, word: str) -> list[int]:
        """Ids of a piece of text without special strings."""
        out: list[int] = []
        memo = self.piece_memo
        if LATIN(word):
            for piece in self.split(word.lower()):
                ids = memo.get(piece)
                if ids is None:
                    raw = piece.encode()
                    ids = list(map(self.first.__getitem__, raw))
                    ids[-1] = self.final[raw[-1]]
                    ids = self._remember(piece, self.merged(ids))
                out += ids
            return out
        for piece, _ in self.pieces(self.normal(word)):
            ids = memo.get("\0" + piece)  # here in the vocabulary's letters
            if ids is None:
                ids = [self.vocab[c] for c in piece[:-1]] + [self.vocab[piece[-1] + self.tail]]
                ids = self._remember("\0" + piece, self.merged(ids))
            out += ids
        return out

    def _remember(self, piece: str, ids: list[int]) -> list[int]:
        """Pieces recur in other words (case, punctuation)."""
        if len(piece) <= 64:
            if len(self.piece_memo) >= MEMO_ENTRIES:
                self.piece_memo.clear()
            self.piece_memo[piece] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """The vocabulary has no decoder: tokens joined by one space."""
        return " ".join([self.tokens[i] for i in ids])


class Lexicon:
    """The automaton: transitions sorted by (state, byte)."""

    FIELDS = ("keys", "to", "before", "final", "id_at", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, words: dict[bytes, list[int]]) -> Lexicon:
        """Minimal automaton of the words (added in order, with the suffixes of
        a finished branch replaced by an equal registered state)."""
        kept = sorted(w for w in words if 0 < len(w) <= LONGEST)
        edges: list[dict[int, int]] = [{}]
        final = [False]
        register: dict[tuple, int] = {}
        path: list[tuple[int, int, int]] = []  # (parent, byte, child) not yet registered

        def settle(depth: int) -> None:
            while len(path) > depth:
                parent, byte, child = path.pop()
                sign = (final[child], tuple(edges[child].items()))
                same = register.setdefault(sign, child)
                edges[parent][byte] = same

        last = b""
        for w in kept:
            common = len(os.path.commonprefix([last, w]))
            settle(common)
            state = path[-1][2] if path else 0
            for byte in w[common:]:
                edges.append({})
                final.append(False)
                edges[state][byte] = len(edges) - 1
                path.append((state, byte, len(edges) - 1))
                state = len(edges) - 1
            final[state] = True
            last = w
        settle(0)
        # renumber the states in use, children counted before their parents
        order, number = [0], {0: 0}
        for s in order:
            for c in edges[s].values():
                if c not in number:
                    number[c] = len(order)
                    order.append(c)
        size: dict[int, int] = {}
        stack = [0]
        while stack:
            s = stack[-1]
            todo = [c for c in edges[s].values() if c not in size]
            if todo:
                stack += todo
                continue
            size[s] = final[s] + sum(size[c] for c in edges[s].values())
            stack.pop()
        rows = []
        for s in order:
            before = int(final[s])
            for byte, c in sorted(edges[s].items()):
                rows.append((number[s] << 8 | byte, number[c], before))
                before += size[c]
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        ids = [np.array(words[w], dtype=np.uint32) for w in kept]
        return cls(
            {
                "keys": table[:, 0].copy(), "to": table[:, 1].astype(np.int32), "before": table[:, 2].astype(np.int32),
                "final": np.array([final[s] for s in order], dtype=np.uint8),
                "id_at": np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64),
                "ids": np.concatenate(ids) if ids else np.zeros(0, np.uint32),
            }
        )

    def save(self, path: str) -> None:
        with open(path, "wb") as f:
            at, head = 0, []
            for name in self.FIELDS:
                a = getattr(self, name)
                head.append([name, a.dtype.str, len(a), at])
                at += -(-a.nbytes // 8) * 8
            raw = json.dumps(head).encode()
            raw += b" " * (-len(raw) % 8)
            f.write(struct.pack("<Q", len(raw)) + raw)
            for name in self.FIELDS:
                a = getattr(self, name)
                f.write(a.tobytes() + bytes(-a.nbytes % 8))

    @classmethod
    def open(cls, path: str) -> Lexicon:
        whole = np.memmap(path, np.uint8, "r")
        size = int(whole[:8].view("<u8")[0])
        base = 8 + size
        found = {}
        for name, kind, n, at in json.loads(bytes(whole[8:base])):
            found[name] = np.asarray(whole[base + at : base + at + n * np.dtype(kind).itemsize]).view(kind)
        return cls(found)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 if it isn't in the lexicon."""
        size = np.array([len(w) for w in words])
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not len(words):
            return out
        live = np.flatnonzero((size > 0) & (size <= LONGEST))
        if not len(live):
            return out
        text = np.frombuffer(b"".join([words[i].ljust(LONGEST, b"\0") for i in live]), np.uint8).reshape(-1, LONGEST)
        row, size = np.arange(len(live)), size[live]
        state, number = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        for k in range(LONGEST):
            key = state << 8 | text[row, k]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            row, at, number = row[ok], at[ok], number[ok]
            state = self.to[at].astype(np.int64)
            number = number + self.before[at]
            end = size[row] == k + 1
            hit = end & (self.final[state] == 1)
            out[live[row[hit]]] = number[hit]
            row, state, number = row[~end], state[~end], number[~end]
            if not len(row):
                break
        return out


_SEPARATORS = re.compile("[\x1c-\x1f]").search


def blank_split(text: str) -> list[str]:
    """Blank-separated words; the four control separators that only Python
    takes for blanks stay inside words."""
    if _SEPARATORS(text):
        return re.findall(f"[^{UNICODE_BLANKS}]+", text)
    return text.split()


class Codec:
    """A worker's encoder: lexicon first, exact merges for the rest."""

    def __init__(self, vocab_path: str, lexicon: Lexicon | None, memo_entries: int = MEMO_ENTRIES):
        self.bpe, self.lexicon = WordBpe(vocab_path), lexicon
        self.memo: dict[str, bytes] = {}
        self.memo_entries = memo_entries

    def learn(self, words: set[str]) -> list[str]:
        """Put the packed ids of a batch's distinct words into the memo; the long
        ones, which are not to stay there."""
        memo = self.memo
        todo = list(words.difference(memo))
        if len(memo) + len(todo) > self.memo_entries:
            memo.clear()
            todo = list(words)
        if todo and self.lexicon is not None:
            found = self.lexicon.find([w.encode() for w in todo])
            ids, at = self.lexicon.ids, self.lexicon.id_at
            for i in np.flatnonzero(found >= 0).tolist():
                k = found[i]
                memo[todo[i]] = ids[at[k] : at[k + 1]].tobytes()
            todo = [todo[i] for i in np.flatnonzero(found < 0).tolist()]
        encode = self.bpe.encode_word
        for w in todo:
            memo[w] = array("I", encode(w)).tobytes()
        return [w for w in todo if len(w) > 64]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each whole text."""
        cut = self.bpe.special_cut
        marked = [any(s in t for s in self.bpe.special) for t in texts]
        parts = [[blank_split(p) if k % 2 == 0 else p for k, p in enumerate(cut(t))] if m else blank_split(t) for t, m in zip(texts, marked, strict=True)]
        seen: set[str] = set()
        for p, m in zip(parts, marked, strict=True):
            for q in (p[::2] if m else (p,)):
                seen.update(q)
        long = self.learn(seen)
        get = self.memo.__getitem__
        out = []
        for p, m in zip(parts, marked, strict=True):
            if m:
                out.append(b"".join(b"".join(map(get, q)) if isinstance(q, list) else struct.pack("<I", self.bpe.special[q]) for q in p))
            else:
                out.append(b"".join(map(get, p)))
        for w in long:
            del self.memo[w]
        return out

    def decode(self, packed: list[bytes]) -> list[str]:
        """Text of ids as the vocabulary's library gives it."""
        names = self.token_names()
        return [" ".join(names[np.frombuffer(p, "<u4")].tolist()) for p in packed]

    def token_names(self) -> np.ndarray:
        if not hasattr(self, "_names"):
            self._names = np.empty(max(self.bpe.tokens) + 1, dtype=object)
            for i, t in self.bpe.tokens.items():
                self._names[i] = t
        return self._names


_CODECS: dict[tuple, Codec] = {}


def codec(vocab_path: str, lexicon_file: str | None) -> Codec:
    key = (vocab_path, lexicon_file)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocab_path, Lexicon.open(SparkFiles.get(lexicon_file)) if lexicon_file else None)
    return _CODECS[key]


def frequent_words(docs: DataFrame, text_col: str = "text", words: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent blank-separated words of at most LONGEST bytes, as many
    whole steps of frequency as hold at most ``words``, counted over all
    documents; counts are combined per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in batches:
            c: Counter[str] = Counter()
            for t in text_column(batch.column(0)):
                c.update(blank_split(t.as_py()))
            for w in [w for w in c if len(w.encode()) > LONGEST]:
                del c[w]
            yield pa.record_batch([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["w", "n"])

    spark = docs.sparkSession
    got = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).mapInArrow(run, "w string, n long")
    got = spark.read.parquet(write_scratch(got.groupBy("w").agg(F.sum("n").alias("n")), "words"))
    # eight steps per doubling of the count: some hundred rows tell how far down
    # the counts the bound reaches, so no task sends more than that
    step = F.floor(F.log2("n") * 8)
    total, least = 0, None
    for r in sorted(got.groupBy(step.alias("s")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r["s"]):
        total += r["k"]
        if total > words:
            break
        least = r["s"]
    return got.where(step >= least) if least is not None else got.limit(words)


def build_lexicon(spark: SparkSession, docs: DataFrame, vocab_path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the lexicon on the driver (its size is bounded) and send it to
    the executors; the name by which workers open it."""
    bpe = WordBpe(vocab_path)
    found = [r["w"] for r in frequent_words(docs, text_col, words).collect()]
    lexicon = Lexicon.compile({w.encode(): bpe.encode_word(w) for w in found if not any(s in w for s in bpe.special)})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="quire-lexicon-"), name)
    lexicon.save(path)
    spark.sparkContext.addFile(path)
    return name


def encode(
    spark: SparkSession, docs: DataFrame, vocab_path: str, text_col: str = "text", carry: list[str] | None = None, lexicon: str | None = None, outputs: tuple[str, ...] = ("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")
) -> DataFrame:
    """The ``carry`` columns (all by default) and the outputs asked for: ids as
    little-endian 32-bit integers, the decoded text, digests of both.

    As the public library gives them: whole texts, special strings in a text as
    their single ids, nothing added. Null and empty texts have no ids and decode
    to an empty text; repeated rows give repeated results; an empty table gives
    none; a carried column named as an output is replaced by it.
    """
    lexicon = lexicon or build_lexicon(spark, docs, vocab_path, text_col)
    keep = [c for c in (docs.columns if carry is None else carry) if c not in outputs]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(spare(keep)))
    kinds = {"n_tokens": "long", "ids": "binary", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), *(f"{o} {kinds[o]}" for o in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocab_path, lexicon)
        for batch in batches:
            col = text_column(batch.column(batch.num_columns - 1))
            step = 2000
            for i in range(0, batch.num_rows, step):
                texts = col.slice(i, step).to_pylist()
                ids = own.encode(texts)
                made = {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
                if "ids_sha256" in outputs:
                    made["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
                if {"decoded", "decoded_sha256"} & {*outputs}:
                    back = own.decode(ids)
                    made["decoded"] = pa.array(back, pa.string())
                    made["decoded_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string())
                yield pa.record_batch([c.slice(i, step) for c in batch.columns[:-1]] + [made[o] for o in outputs], names=[*keep, *outputs])

    return src.mapInArrow(run, schema)
