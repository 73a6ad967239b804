"""Quality rules: a hashed word and character n-gram logistic regression behind
fixed base rules.

The model is trained on a bounded sample of labelled rows inside one Spark task
(the texts never reach the driver; the weights, of fixed size, do), calibrated
on a held-out fifth of the sample, and broadcast to the tasks that score Arrow
batches. Features are the distinct hashed word unigrams, word bigrams and
character 3- and 5-grams (bytes) of a whole text, averaged per kind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.textarrays import GOLDEN, SPACE, Texts, U, chunks, combine, fold, span_names, text_column

BITS = 15  # slots of each feature kind; the weights are 4 * 2^15 floats
KINDS = 4
SAMPLE_ROWS = 4000  # bound of the labelled sample, by smallest hash of the id
KEEP_AT = 0.3  # fixed threshold on the calibrated probability of quality 1
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def features(t: Texts) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind: slots of its n-grams, and where each text's start and end;
    an n-gram that runs into the next text is no text's."""
    shift = U(64 - BITS)
    names, b = t.names, t.bounds
    one = (names * GOLDEN >> shift).astype(np.int32)
    two = np.empty(0, np.int32)
    if len(names) > 1:
        two = (combine(names[:-1], names[1:], 2) >> shift).astype(np.int32)
    off, d = t.off, t.data.astype(np.uint32)
    ends = lambda edges, n: np.maximum(edges[1:] - n + 1, edges[:-1])
    kinds = [(one, b[:-1], b[1:]), (two, b[:-1], ends(b, 2))]
    for n in (3, 5):
        k = max(t.size - n + 1, 0)
        h = np.zeros(k, dtype=np.uint32)
        for j in range(n):
            h = (h + d[j : j + k]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        kinds.append(((h >> np.uint32(32 - BITS)).astype(np.int32), off[:-1], ends(off, n)))
    return kinds


def segment_mean(v: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    # each text summed by itself, so that no neighbour changes a digit
    edges = np.minimum(np.stack([start, end], axis=1).ravel(), len(v))
    total = np.add.reduceat(np.append(v, 0), edges, dtype=np.float64)[::2]
    return np.where(end > start, total, 0) / np.maximum(end - start, 1)


def margins(t: Texts, weights: np.ndarray, bias: float) -> np.ndarray:
    """Sum over kinds of the mean weight of a text's n-grams."""
    z = np.full(len(t.off) - 1, bias)
    for k, (slots, start, end) in enumerate(features(t)):
        z += segment_mean(weights[k][slots], start, end)
    return z


@dataclass
class Model:
    weights: np.ndarray  # KINDS x 2^BITS float32
    bias: float
    scale: float  # calibrated: 1 / (1 + exp(-(scale * margin + shift)))
    shift: float

    def probability(self, t: Texts) -> np.ndarray:
        z = self.scale * margins(t, self.weights, self.bias) + self.shift
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: pa.Array, y: np.ndarray, held: np.ndarray, epochs: int = 60) -> Model:
    """Full-batch Adam over the sparse n-gram frequencies (sqrt-damped counts are
    not needed: the rows are means), then Platt scaling on the held-out rows."""
    size = 1 << BITS
    rows, cols, vals = [], [], []
    at = 0
    for i, n in chunks(texts):
        t = Texts(texts.slice(i, n))
        for k, (slots, start, end) in enumerate(features(t)):
            cnt = end - start
            r = np.repeat(np.arange(n), cnt)
            place = np.arange(len(r)) + np.repeat(start - (np.cumsum(cnt) - cnt), cnt)
            code, c = np.unique(r * size + slots[place], return_counts=True)
            r = code // size
            rows.append((at + r).astype(np.int32))
            cols.append((code % size + k * size).astype(np.int32))
            vals.append((c / np.maximum(cnt, 1)[r]).astype(np.float32))
        at += n
    w = np.zeros(KINDS * size, np.float64)
    if not rows or len(set(y[~held].tolist())) < 2:  # nothing to tell apart
        p = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Model(w.reshape(KINDS, size).astype(np.float32), float(np.log(p / (1 - p))), 1.0, 0.0)
    r, c, v = (np.concatenate(x) for x in (rows, cols, vals))
    use = ~held
    cls = np.where(y == 1, 0.5 / max(1, (y[use] == 1).sum()), 0.5 / max(1, (y[use] == 0).sum())) * use
    bias, m, s, mb, sb = 0.0, np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, epochs + 1):
        z = np.bincount(r, weights=v * w[c], minlength=len(y)) + bias
        g = cls * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        gw = np.bincount(c, weights=v * g[r], minlength=len(w)) + 1e-7 * w
        gb = g.sum()
        m, s = 0.9 * m + 0.1 * gw, 0.99 * s + 0.01 * gw * gw
        mb, sb = 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        rate = 0.5
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(sb / (1 - 0.99**step)) + 1e-9)
    z = np.bincount(r, weights=v * w[c], minlength=len(y)) + bias
    a, d = platt(z[held], y[held]) if len(set(y[held].tolist())) == 2 else (1.0, 0.0)
    return Model(w.reshape(KINDS, size).astype(np.float32), bias, a, d)


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps of a two-parameter logistic fit with Platt's soft targets."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    mean, dev = z.mean(), z.std() + 1e-9
    x = np.stack([(z - mean) / dev, np.ones_like(z)])
    q = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(q @ x, -40, 40)))
        h = (x * (p * (1 - p) + 1e-9)) @ x.T + 1e-3 * np.eye(2)
        q -= np.linalg.solve(h, x @ (p - t) + 1e-3 * q)
    return float(q[0] / dev), float(q[1] - q[0] * mean / dev)


def base_counts(t: Texts) -> dict[str, np.ndarray]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words and n_words of each text."""
    n = len(t.off) - 1
    d, b, off = t.data[: t.size], t.bounds, t.off
    count = lambda mask, edges: np.diff(np.concatenate([[0], np.cumsum(mask)])[edges])
    out = {"n_words": t.n_words.astype(np.int64)}
    out["word_chars"] = count(((d & 0xC0) != 0x80) & ~SPACE[d], off)
    out["n_symbols"] = count(SYMBOLS[d], off)

    # lines: a text's pieces between line feeds; those with a word are counted
    feeds = np.flatnonzero(d == 0x0A)
    start = np.unique(np.concatenate([off[:-1], feeds + 1]))
    owner = np.searchsorted(off, start, side="right") - 1
    ok = (owner < n) & (start < off[np.minimum(owner + 1, n)])  # an empty line holds no word
    start, owner = start[ok], owner[ok]
    nxt = np.searchsorted(feeds, start)
    stop = np.minimum(np.append(feeds, t.size)[nxt], off[owner + 1])
    has = np.searchsorted(t.starts, stop) > np.searchsorted(t.starts, start)
    start, stop, owner = start[has], stop[has], owner[has]
    dup = np.zeros(n, np.int64)
    if len(start):
        key = span_names(t.data, start, stop)
        dup = np.bincount(owner, minlength=n) - np.bincount(np.unique(np.stack([owner.astype(np.uint64), key]), axis=1)[0].astype(np.int64), minlength=n)
    out["n_dup_lines"] = dup

    # words in 3-word windows that the text has twice or more
    rep = np.zeros(n, np.int64)
    doc, names = t.doc, t.names
    if len(names) >= 3:
        at = np.flatnonzero(doc[:-2] == doc[2:])
        key = combine(fold(names, at, 3, 5), doc[at].astype(np.uint64))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        p = at[twice]
        covered = np.zeros(len(names), bool)
        for j in range(3):
            covered[p + j] = True
        rep = np.bincount(doc[covered], minlength=n)
    out["n_repeat_words"] = rep.astype(np.int64)
    return out


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled rows per class, those with the
    smallest hash of their id (so never by position), read in one task."""
    h = F.xxhash64(F.lit(10), F.col(id_col).cast("string"))
    lab = labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("k"), F.col("quality").cast("int").alias("y"), h.alias("h"))
    lab = lab.groupBy("k").agg(F.max("h").alias("h"), F.max("y").alias("y"), F.min("y").alias("y0")).where("y = y0")
    picked = [lab.where(F.col("y") == v).orderBy("h", "k").limit(sample_rows) for v in (0, 1)]
    chosen = picked[0].unionByName(picked[1])  # at most 2 * sample_rows short rows: safe to broadcast
    rows = docs.select(F.col(id_col).cast("string").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).join(F.broadcast(chosen), "k")
    # of several texts of one id, that of the smallest hash
    rows = rows.groupBy("k").agg(F.min_by("t", F.struct(F.xxhash64("t"), F.col("t"))).alias("t"), F.first("y").alias("y"), F.first("h").alias("h"))
    rows = rows.select("t", "y", (F.pmod("h", F.lit(5)) == 0).alias("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            t = pa.Table.from_batches(got).combine_chunks()
            m = fit(text_column(t.column(0)), t.column(1).to_numpy().astype(np.int64), t.column(2).to_numpy(zero_copy_only=False).astype(bool))
            yield pa.record_batch([pa.array([m.weights.tobytes()], pa.binary()), pa.array([[m.bias, m.scale, m.shift]])], names=["w", "q"])

    got = rows.coalesce(1).mapInArrow(run, "w binary, q array<double>").collect()  # one row, 512 KB
    if not got:
        return Model(np.zeros((KINDS, 1 << BITS), np.float32), 0.0, 1.0, 0.0)
    return Model(np.frombuffer(got[0]["w"], np.float32).reshape(KINDS, -1), *got[0]["q"])


def quality_rules(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT, model: Model | None = None
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, probability, kept) of each row.

    ``base_failed``: under 50 words, or over half of them in repeated 3-word
    windows; ``kept`` is false for those, else probability >= ``keep_at``. Null
    and empty texts have no words, so they fail. Without labels of both classes
    the model gives one probability to all. Repeated rows give repeated results;
    an empty table gives none; other columns aren't read.
    """
    model = model or train(spark, docs, labels, id_col, text_col)
    shared = spark.sparkContext.broadcast(model)  # 512 KB, whatever the corpus
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            ids, col = batch.column(0), text_column(batch.column(1))
            for i, n in chunks(col):
                t = Texts(col.slice(i, n))
                base = base_counts(t)
                cols = [ids.slice(i, n), *(pa.array(base[x].astype(np.int64)) for x in names), pa.array(m.probability(t))]
                yield pa.record_batch(cols, names=[id_col, *names, "probability"])

    src = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    kind = src.schema[0].dataType.simpleString()
    out = src.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{x} long" for x in names) + ", probability double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("probability") >= keep_at))
