"""Masked pseudo-likelihood of documents by a bidirectional window network.

The network's vocabulary is the corpus' most frequent words, more of them in a
larger corpus, and hash buckets for the rest, from counts over all documents; a
word of a bucket has the bucket's probability by its own share of the bucket's
count, which Spark joins for rare words. A network in numpy predicts every word
from two words on each side: an embedding per side position, one hidden layer,
and a softmax in two levels (class, then word). The words' ids are written once
and read by all passes that follow. Every task trains a copy on the
positions of its own documents, a part of them in each round and all of them in
the end; the copies are averaged by Spark in two levels, and the next round
starts from the average. A document's score is the sum of the conditional
log-probabilities of all its words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.textarrays import Texts, U, chunks, mix64, offsets, text_column

CLASSES, PER_CLASS = 64, 40
SIZE = CLASSES * PER_CLASS  # at least; a fifth of the ids are buckets
STEP = 1 / 3  # a word seen this often times the root of the corpus' words has an id
HEAD = 1 << 17  # words whose counts travel to the tasks; others' counts are joined
SIDES = (-2, -1, 1, 2)
HIDDEN = 32
ROUNDS = SHARE = 2  # a round trains on one in SHARE positions, the rounds together on all
BATCH, RATE = 4096, 0.1
SCORED = 1 << 13  # positions scored at once
PARTS = 32  # pieces in which weights travel
TAME = 60  # scores up to this size, their exponentials and sums stay within single precision


@dataclass
class Vocabulary:
    names: np.ndarray  # of the frequent words, ascending
    ids: np.ndarray  # their ids, 0 the most frequent
    log_freq: np.ndarray  # of each id
    log_total: np.ndarray  # log of the words counted for each id, and one for unseen words
    shape: tuple[int, int] = (CLASSES, PER_CLASS)
    head: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # words, ascending
    head_log: np.ndarray = field(default_factory=lambda: np.zeros(0))  # logs of their counts
    counts: str = ""  # folder of the counts (w, n) of all words

    @property
    def size(self) -> int:
        return self.shape[0] * self.shape[1]

    @property
    def words(self) -> int:
        return self.size - self.size // 5

    @property
    def stored(self) -> np.dtype:
        """Type of the ids where they are written."""
        return np.dtype(np.uint16 if self.size < 1 << 16 else np.uint32)

    def encode(self, names: np.ndarray) -> np.ndarray:
        out = (self.words + (mix64(names) % U(self.size // 5)).astype(np.int64)).astype(np.int32)
        at, hit = _find(self.names, names)
        out[hit] = self.ids[at[hit]]
        return out

    def shares(self, names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of each word's share of its id, and the places of words whose count
        isn't at hand: these are given that of a word seen once."""
        out, rest = np.zeros(len(ids)), np.flatnonzero(ids >= self.words)
        at, hit = _find(self.head, names[rest])
        out[rest] = -self.log_total[ids[rest]]
        out[rest[hit]] += self.head_log[at[hit]]
        return out, rest[~hit]


def _find(sorted_names: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_names):
        return np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    at = np.minimum(np.searchsorted(sorted_names, names), len(sorted_names) - 1)
    return at, sorted_names[at] == names


def vocabulary(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    """Counts of all words of all documents, combined per batch and task and
    written; then the most frequent words and the totals of each id. The words
    with ids of their own are those above a count step that grows with the root
    of the corpus, so their number grows too; the driver gets these, the counts
    of at most HEAD words (or twice those with ids), and the totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = text_column(batch.column(0))
            for i, n in chunks(col, 8 << 20):
                names, count = np.unique(Texts(col.slice(i, n)).names, return_counts=True)
                yield pa.record_batch([pa.array(names.view(np.int64)), pa.array(count)], names=["w", "n"])

    counts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).mapInArrow(run, "w long, n long")
    counts = counts.groupBy("w").agg(F.sum("n").alias("n"))
    from quire.session import write_scratch

    path = write_scratch(counts, "word-counts")
    counts = docs.sparkSession.read.parquet(path)
    level = F.floor(F.log2("n") * 8)  # some hundreds at any size
    levels = sorted(counts.groupBy(level.alias("v")).agg(F.count("*"), F.sum("n")).collect(), reverse=True)
    step = math.floor(math.log2(max(STEP * math.sqrt(sum(r[2] for r in levels)), 1)) * 8)
    grow = max(1.0, math.sqrt(sum(r[1] for r in levels if r[0] >= step) / (SIZE - SIZE // 5)))
    shape = (math.ceil(CLASSES * grow), math.ceil(PER_CLASS * grow))
    own = Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0), np.zeros(0), shape)
    least, held = 1 << 30, 0
    for v, words, _ in levels:
        held += words
        if held > max(HEAD, 2 * own.words):
            break
        least = v
    head = counts.where(level >= least).toArrow()
    names, n = head.column("w").to_numpy(), head.column("n").to_numpy()
    order = np.lexsort((names, -n))[: own.words]
    names = names.view(np.uint64)
    rank = np.argsort(names[order])
    own.names, own.ids = names[order][rank], rank.astype(np.int32)
    order = np.argsort(names)
    own.head, own.head_log, own.counts = names[order], np.log(n[order]), path

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(own.size, np.int64)
        for b in batches:
            at = own.encode(b.column(0).to_numpy().view(np.uint64))
            n += np.bincount(at, weights=b.column(1).to_numpy(), minlength=own.size).astype(np.int64)
        yield pa.record_batch([pa.array(np.arange(own.size)), pa.array(n)], names=["i", "n"])

    n = np.zeros(own.size)
    for r in counts.mapInArrow(fold, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        n[r["i"]] = r["n"]
    own.log_freq, own.log_total = np.log((n + 0.5) / (n + 0.5).sum()), np.log(n + 1)
    return own


class Network:
    """Weights as one flat float32 array with named views, for a vocabulary of
    ``shape`` classes times words of a class."""

    @staticmethod
    def shapes(shape: tuple[int, int]) -> dict[str, tuple[int, ...]]:
        c, w = shape
        return {
            "embed": (len(SIDES), c * w + 2, HIDDEN), "hidden": (HIDDEN,), "classes": (HIDDEN, c), "class_bias": (c,),
            "words": (c, HIDDEN, w), "word_bias": (c, w),
        }

    @classmethod
    def length(cls, shape: tuple[int, int]) -> int:
        return sum(math.prod(s) for s in cls.shapes(shape).values())

    def __init__(self, flat: np.ndarray, shape: tuple[int, int] = (CLASSES, PER_CLASS)):
        self.flat, self.shape, at = flat, shape, 0
        for name, dims in self.shapes(shape).items():
            n = math.prod(dims)
            setattr(self, name, flat[at : at + n].reshape(dims))
            at += n

    @classmethod
    def fresh(cls, v: Vocabulary) -> Network:
        """Small random embeddings; biases of the word frequencies."""
        net = cls(np.zeros(cls.length(v.shape), np.float32), v.shape)
        rng = np.random.default_rng(3)
        net.embed[:] = rng.normal(0, 0.1, net.embed.shape)
        net.classes[:] = rng.normal(0, 0.1, net.classes.shape)
        net.words[:] = rng.normal(0, 0.1, net.words.shape)
        p = np.exp(v.log_freq).reshape(v.shape)
        net.class_bias[:] = np.log(p.sum(axis=1))
        net.word_bias[:] = np.log(p / p.sum(axis=1, keepdims=True))
        return net

    def hide(self, context: np.ndarray) -> np.ndarray:
        a = self.embed[0].take(context[:, 0], axis=0)
        for p in range(1, len(SIDES)):
            a += self.embed[p].take(context[:, p], axis=0)
        a += self.hidden
        # tanh(a) = 2 / (1 + exp(-2 a)) - 1, faster than numpy's own
        a *= -2
        with np.errstate(over="ignore"):
            np.exp(a, out=a)
        a += 1
        np.divide(2, a, out=a)
        a -= 1
        return a

    def _outer(self, h: np.ndarray) -> np.ndarray:
        """Scores of the classes."""
        z = h @ self.classes
        z += self.class_bias
        return z

    def _inner(self, h: np.ndarray, edges: list[tuple[int, int, int]], group: np.ndarray) -> np.ndarray:
        """Scores of the words of each row's class; rows are in order of classes."""
        y = np.empty((len(h), self.shape[1]), h.dtype)
        for g, a, b in edges:
            np.matmul(h[a:b], self.words[g], out=y[a:b])
        y += self.word_bias.take(group, axis=0)
        return y

    def _tame(self) -> tuple[bool, bool]:
        """Whether no class or word can have a score beyond TAME, as hidden values lie in -1..1."""
        outer = np.abs(self.classes).sum(axis=0).max() + np.abs(self.class_bias).max()
        inner = np.abs(self.words).sum(axis=1).max() + np.abs(self.word_bias).max()
        return outer <= TAME, inner <= TAME

    def _ordered(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Order of the rows by target, their classes, their words in these, and
        (class, first row, end) of each class there."""
        order = _sorted(target, self.shape[0] * self.shape[1])
        group, inner = np.divmod(target[order], self.shape[1])
        ends = np.searchsorted(group, np.arange(self.shape[0] + 1)).tolist()
        return order, group, inner, [(g, a, b) for g, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a]

    def log_prob(self, context: np.ndarray, target: np.ndarray, tame: tuple[bool, bool] | None = None) -> np.ndarray:
        order, group, inner, edges = self._ordered(target)
        rows, h = np.arange(len(order)), self.hide(context[order])
        sums = []
        for z, at, small in zip((self._outer(h), self._inner(h, edges, group)), (group, inner), tame or self._tame(), strict=True):
            own = z[rows, at]
            total, top = _exp(z, small)
            sums.append(own - top - np.log(total))
        out = np.empty(len(order), np.float32)
        out[order] = sums[0] + sums[1]
        return out

    def step(self, context: np.ndarray, target: np.ndarray, past: np.ndarray) -> None:
        """One Adagrad step on a batch, taken in order of the targets so that each
        class is one range of rows; ``past`` sums the squared gradients. Of the
        embeddings only the rows of words in the batch are touched."""
        seen, tame = Network(past, self.shape), self._tame()
        order, group, inner, edges = self._ordered(target)
        context = context[order]
        rows, h = np.arange(len(order)), self.hide(context)
        one = np.ones((len(order), HIDDEN + 1), h.dtype)  # a column of ones sums the biases' slopes
        one[:, :HIDDEN] = h
        dz, dy = self._outer(h), self._inner(h, edges, group)
        _slope(dz, rows, group, tame[0])
        _slope(dy, rows, inner, tame[1])
        words, dh = np.zeros((self.shape[0], HIDDEN + 1, self.shape[1]), h.dtype), np.empty_like(h)
        for g, a, b in edges:
            np.matmul(one[a:b].T, dy[a:b], out=words[g])
            np.matmul(dy[a:b], self.words[g].T, out=dh[a:b])
        dh += dz @ self.classes.T
        h *= h
        np.subtract(1, h, out=h)
        dh *= h
        classes = one.T @ dz
        found = {"hidden": dh.sum(axis=0), "classes": classes[:HIDDEN], "class_bias": classes[HIDDEN], "words": words[:, :HIDDEN], "word_bias": words[:, HIDDEN]}
        for name, g in found.items():
            w, s = getattr(self, name), getattr(seen, name)
            s += g * g
            w -= RATE * g / (np.sqrt(s) + 1e-6)
        slopes = np.ascontiguousarray(dh.T, np.float64)
        for p in range(len(SIDES)):
            at, place = _distinct(context[:, p], self.embed.shape[1])
            g = np.empty((len(at), HIDDEN), h.dtype)
            for j in range(HIDDEN):
                g[:, j] = np.bincount(place, weights=slopes[j], minlength=len(at))
            s = seen.embed[p].take(at, axis=0) + g * g
            seen.embed[p][at] = s
            self.embed[p][at] -= RATE * g / (np.sqrt(s) + 1e-6)


def _distinct(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids below ``size``, and each one's place among them."""
    by = _sorted(ids, size)
    c = ids[by]
    new = np.concatenate([[True], c[1:] != c[:-1]])
    place = np.empty(len(ids), np.int64)
    place[by] = np.cumsum(new) - 1
    return c[new], place


def _sorted(ids: np.ndarray, size: int) -> np.ndarray:
    """Stable order of ids below ``size``; 16-bit ones are sorted by radix."""
    return np.argsort(ids.astype(np.uint16) if size < 1 << 16 else ids, kind="stable")


def _exp(z: np.ndarray, tame: bool) -> tuple[np.ndarray, np.ndarray | int]:
    """Exponentials in place of scores, less each row's largest unless all are
    ``tame``; their sums and what was taken off."""
    top: np.ndarray | int = 0
    if not tame:
        top = z.max(axis=1)
        z -= top[:, None]
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], z.dtype), top


def _slope(z: np.ndarray, rows: np.ndarray, at: np.ndarray, tame: bool) -> None:
    """In place of scores, the slope of the mean loss of a softmax."""
    total, _ = _exp(z, tame)
    z *= (1 / (total * len(z)))[:, None]
    z[rows, at] -= np.float32(1 / len(z))


# of the smallest vocabulary
Network.LENGTH = Network.length((CLASSES, PER_CLASS))


def contexts(ids: np.ndarray, doc: np.ndarray, at: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Ids on each side of the positions; beyond a text's ends size and size + 1."""
    out = np.empty((len(at), len(SIDES)), np.int32)
    for p, d in enumerate(SIDES):
        j = at + d
        inside = (j >= 0) & (j < len(ids))
        j = np.clip(j, 0, max(len(ids) - 1, 0))
        inside &= doc[j] == doc[at]
        out[:, p] = np.where(inside, ids[j], size + (d > 0))
    return out


class Coded:
    """Word ids of some texts, with the layout of Texts: ``names`` are the ids."""

    def __init__(self, col: pa.Array, v: Vocabulary):
        off, kind = offsets(col), v.stored
        raw = col.buffers()[2] if off[-1] > off[0] else b""
        self.ids = np.frombuffer(raw, kind, int(off[-1] - off[0]) // kind.itemsize, int(off[0]) if raw else 0).astype(np.int32)
        self.bounds = (off - off[0]) // kind.itemsize
        self.doc = np.repeat(np.arange(len(col)), np.diff(self.bounds))

    @property
    def names(self) -> np.ndarray:
        return self.ids.astype(np.uint64)


def turn(t: Texts | Coded, k: int, share: int) -> np.ndarray:
    """Positions of round ``k``: one residue of a hash of the word and its place in
    its text, so that any ``share`` rounds in a row have each position once."""
    place = np.arange(len(t.doc)) - t.bounds[:-1][t.doc]
    return np.flatnonzero(mix64(t.names ^ mix64(place.astype(np.uint64))) % U(share) == k % share)


def coded(docs: DataFrame, v: Vocabulary, id_col: str | None = None, text_col: str = "text") -> DataFrame:
    """(row, id, n_words, share, rare, ids) of each row, written once for the
    passes of training and scoring: the words' ids as packed integers, the sum of
    the logs of their shares, and the names of words whose share isn't at hand."""
    from quire.session import write_scratch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = text_column(batch.column(2))
            for i, m in chunks(col):
                t = Texts(col.slice(i, m))
                ids = v.encode(t.names)
                share, rare = v.shares(t.names, ids)
                total = np.bincount(t.doc, weights=share, minlength=m).astype(np.float64)  # of no words at all: integers
                edges = np.searchsorted(rare, t.bounds).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(edges), pa.array(t.names[rare].view(np.int64)))
                raw, ends = ids.astype(v.stored).tobytes(), (t.bounds * v.stored.itemsize).tolist()
                packed = pa.array([raw[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
                yield pa.record_batch(
                    [batch.column(0).slice(i, m), batch.column(1).slice(i, m), pa.array(t.n_words.astype(np.int64)), pa.array(total), rare, packed],
                    names=["row", "id", "n_words", "share", "rare", "ids"],
                )

    id_ = F.col(id_col) if id_col else F.lit(None).cast("int")
    src = docs.select(F.monotonically_increasing_id().alias("row"), id_.alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    kind = src.schema[1].dataType.simpleString()
    # written, so that a row keeps its number
    made = src.mapInArrow(run, f"row long, id {kind}, n_words long, share double, rare array<long>, ids binary")
    return docs.sparkSession.read.parquet(write_scratch(made, "word-ids"))


def train(spark: SparkSession, docs: DataFrame, v: Vocabulary, text_col: str = "text", rounds: int = ROUNDS, share: int = SHARE) -> Network:
    return train_coded(spark, coded(docs, v, text_col=text_col), v, rounds, share)


def train_coded(spark: SparkSession, rows: DataFrame, v: Vocabulary, rounds: int = ROUNDS, share: int = SHARE) -> Network:
    """The network after ``rounds`` over the word ids of ``rows``."""
    net = Network.fresh(v)
    cut = -(-len(net.flat) // PARTS)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast((v, net.flat))  # 4 MB, and 640 bytes for each further id

        def run(batches: Iterator[pa.RecordBatch], shared=shared, k: int = k) -> Iterator[pa.RecordBatch]:
            v, start = shared.value
            own, past, n = Network(start.copy(), v.shape), np.full(len(start), 1e-6, np.float32), 0
            x, y = np.empty((0, len(SIDES)), np.int32), np.empty(0, np.int32)
            for batch in batches:
                for i, m in chunks(batch.column(0)):
                    t = Coded(batch.column(0).slice(i, m), v)
                    at = turn(t, k, share)
                    x, y = np.concatenate([x, contexts(t.ids, t.doc, at, v.size)]), np.concatenate([y, t.ids[at]])
                    full = len(y) - len(y) % BATCH
                    for j in range(0, full, BATCH):
                        own.step(x[j : j + BATCH], y[j : j + BATCH], past)
                    x, y, n = x[full:], y[full:], n + full
            if len(y):
                own.step(x, y, past)
                n += len(y)
            if n:
                seat = int(start.view(np.uint32)[:16].sum() + own.flat.view(np.uint32)[:4096].sum(dtype=np.uint64)) % 64
                parts = [own.flat[p * cut : (p + 1) * cut].tobytes() for p in range(PARTS)]
                yield pa.record_batch([pa.array(range(PARTS), pa.int32()), pa.array([seat] * PARTS, pa.int32()), pa.array([n] * PARTS, pa.int64()), pa.array(parts, pa.binary())], names=["part", "seat", "n", "w"])

        def mean(table: pa.Table) -> pa.Table:
            n = table.column("n").to_numpy().astype(np.float64)
            total = np.zeros(len(table.column("w")[0].as_py()) // 4)
            for weight, w in zip(n, table.column("w"), strict=True):
                total += weight * np.frombuffer(w.as_py(), np.float32)
            out = (total / n.sum()).astype(np.float32).tobytes()
            return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "n": pa.array([int(n.sum())], pa.int64()), "w": pa.array([out], pa.binary())})

        got = rows.select("ids").mapInArrow(run, "part int, seat int, n long, w binary")
        got = got.groupBy("part", "seat").applyInArrow(mean, "part int, n long, w binary")
        got = got.groupBy("part").applyInArrow(mean, "part int, n long, w binary").collect()
        if got:
            net = Network(np.concatenate([np.frombuffer(r["w"], np.float32) for r in sorted(got, key=lambda r: r["part"])]).copy(), v.shape)
        shared.unpersist()
    return net


def lm_scores(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: tuple[Vocabulary, Network] | None = None) -> DataFrame:
    """(id, n_words, log_prob, mean_log_prob) of each row.

    ``log_prob`` is the sum over all words of a whole text of the logarithm of
    their conditional probability (a bucket's is shared by its words as their
    counts in the corpus; a word the corpus lacks counts as seen once). Null and
    empty texts have no words and 0 for both; equal texts score alike to single
    precision; an empty table gives none; other columns aren't read. Training
    visits documents in the order of their partitions, so other partitions give
    slightly different weights.
    """
    v = model[0] if model else vocabulary(docs, text_col)
    rows = coded(docs, v, id_col, text_col)
    net = model[1] if model else train_coded(spark, rows, v)
    shared = spark.sparkContext.broadcast((v, net.flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, flat = shared.value
        net = Network(flat, v.shape)
        tame = net._tame()
        for batch in batches:
            col = batch.column(4)
            for i, m in chunks(col):
                t = Coded(col.slice(i, m), v)
                total = batch.column(3).slice(i, m).to_numpy().copy()
                for k in range(0, len(t.ids), SCORED):
                    at = np.arange(k, min(k + SCORED, len(t.ids)))
                    total += np.bincount(t.doc[at], weights=net.log_prob(contexts(t.ids, t.doc, at, v.size), t.ids[at], tame), minlength=m)
                yield pa.record_batch([*[batch.column(c).slice(i, m) for c in range(3)], pa.array(total)], names=["row", "id", "n_words", "log_prob"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.select("row", "id", "n_words", "share", "ids").mapInArrow(run, f"row long, id {kind}, n_words long, log_prob double")
    log_prob = F.col("log_prob")
    if v.counts:
        # counts of rare words; one seen once adds nothing
        often = spark.read.parquet(v.counts).where("n > 1")
        more = rows.select("row", F.explode("rare").alias("w")).join(often, "w").groupBy("row").agg(F.sum(F.log("n")).alias("more"))
        out, log_prob = out.join(more, "row", "left"), log_prob + F.coalesce("more", F.lit(0.0))
    return out.select(F.col("id").alias(id_col), "n_words", log_prob.alias("log_prob"), (log_prob / F.greatest("n_words", F.lit(1))).alias("mean_log_prob"))
