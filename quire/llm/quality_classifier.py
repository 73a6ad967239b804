"""Quality classifier: regularised quadratic discriminant analysis.

Every whole text becomes a short vector of document statistics, transformed
towards normality. For each class the count, mean and scatter of the labelled
vectors are summed by Spark over all labelled rows (no sample); the covariance
is shrunk towards the pooled one and its diagonal, and its Cholesky factor is
kept. A score is the logistic of the calibrated difference of the two Gaussian
log-densities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.textarrays import Texts, chunks, combine, spare, text_column
from quire.session import write_scratch

THRESHOLD = 0.7
SHRINK = 0.1  # share of the pooled covariance
RIDGE = 0.02  # share of the diagonal
STATS = (
    "log_words", "word_bytes", "word_bytes_dev", "distinct", "top_word", "adjacent_equal", "distinct_pairs",
    "upper", "digits", "symbols", "marks", "bar_words", "bang_words", "log_line_words", "repeat_lines", "stops",
)


def _class(chars: str) -> np.ndarray:
    m = np.zeros(256, bool)
    m[[ord(c) for c in chars]] = True
    return m


UPPER, DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
SYMBOL, MARKS = _class("#*$%&<>{}[]\\/=+_~^@"), _class("!?;:")


def statistics(t: Texts) -> np.ndarray:
    """One row of STATS per text; all zeros for a text without words."""
    n, b, doc, names = len(t.off) - 1, t.bounds, t.doc, t.names
    d, off = t.data[: t.size], t.off
    words = t.n_words.astype(float)
    has = np.maximum(words, 1)
    chars = np.maximum(np.diff(off), 1).astype(float)
    size = (t.ends - t.starts).astype(float)

    def by_text(v: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0.0], np.cumsum(v, dtype=np.float64)])[edges])

    def share(mask: np.ndarray) -> np.ndarray:
        return by_text(mask[d], off) / chars

    mean = by_text(size, b) / has
    dev = np.sqrt(np.maximum(by_text(size * size, b) / has - mean**2, 0))
    order = np.lexsort((names, doc))
    w, o = names[order], doc[order]
    head = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (o[1:] != o[:-1])])) if len(w) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([head, [len(w)]]))
    distinct = np.bincount(o[head], minlength=n).astype(float)
    top = np.zeros(n)
    np.maximum.at(top, o[head], count)
    mate = doc[1:] == doc[:-1]
    equal = np.bincount(doc[1:][mate & (names[1:] == names[:-1])], minlength=n).astype(float)
    pairs = np.unique(np.stack([doc[1:][mate].astype(np.uint64), combine(names[:-1], names[1:], 3)[mate]]), axis=1) if mate.any() else np.zeros((2, 0), np.uint64)
    distinct_pairs = np.bincount(pairs[0].astype(np.int64), minlength=n) / np.maximum(words - 1, 1)
    last = d[t.ends - 1] if len(t.ends) else np.zeros(0, np.uint8)
    bars = by_text((size == 1) & (last == ord("|")), b) / has
    bangs = by_text(last == ord("!"), b) / has
    lines = by_text(d == 0x0A, off) + 1
    short = by_text(size <= 3, b) / has
    feeds = np.flatnonzero(d == 0x0A)
    line_no = doc + np.searchsorted(feeds, t.starts)
    new_line = np.concatenate([[True], line_no[1:] != line_no[:-1]]) if len(names) else np.zeros(0, bool)
    firsts = np.flatnonzero(new_line)
    repeat = np.zeros(n)
    if len(firsts):
        # a line by the sum of its words' names: order apart, equal lines are equal
        line_key = np.add.reduceat(names, firsts)
        pair = np.unique(np.stack([doc[firsts].astype(np.uint64), line_key]), axis=1)
        all_lines = np.bincount(doc[firsts], minlength=n)
        repeat = 1 - np.bincount(pair[0].astype(np.int64), minlength=n) / np.maximum(all_lines, 1)
    x = np.stack(
        [
            np.log1p(words), np.log1p(mean), np.log1p(dev), distinct / has, np.sqrt(top / has), np.sqrt(equal / has), distinct_pairs,
            np.sqrt(share(UPPER)), np.sqrt(share(DIGIT)), np.sqrt(share(SYMBOL)), np.sqrt(share(MARKS)),
            np.sqrt(bars), np.sqrt(bangs), np.log1p(words / lines), np.sqrt(np.maximum(repeat, 0)), short,
        ],
        axis=1,
    )
    x[words == 0] = 0.0
    return x


@dataclass
class Discriminant:
    """Per class: log prior, mean, inverse Cholesky factor and its log
    determinant; ``scale`` and ``shift`` calibrate the difference."""

    mean: np.ndarray  # 2 x k
    whiten: np.ndarray  # 2 x k x k
    log_det: np.ndarray
    prior: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        z = [((x - self.mean[c]) @ self.whiten[c].T) for c in (0, 1)]
        dens = [self.prior[c] + self.log_det[c] - 0.5 * (z[c] ** 2).sum(axis=1) for c in (0, 1)]
        return dens[1] - dens[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.difference(x) + self.shift, -40, 40)))


def discriminant(n: np.ndarray, total: np.ndarray, scatter: np.ndarray) -> Discriminant:
    """From each class's count, sum and sum of outer products. A class without
    rows takes the other's shape, so its scores only follow the priors."""
    k = total.shape[1]
    if n.sum() == 0:
        return Discriminant(np.zeros((2, k)), np.stack([np.eye(k)] * 2), np.zeros(2), np.log([0.5, 0.5]))
    mean = np.stack([total[c] / n[c] if n[c] else total.sum(0) / n.sum() for c in (0, 1)])
    cov = np.stack([scatter[c] / n[c] - np.outer(mean[c], mean[c]) if n[c] else np.zeros((k, k)) for c in (0, 1)])
    pooled = (cov * (n / n.sum())[:, None, None]).sum(axis=0)
    floor = np.diag(pooled).mean() * 1e-3 + 1e-6
    whiten, log_det = [], []
    for c in (0, 1):
        s = (1 - SHRINK) * cov[c] + SHRINK * pooled if n[c] else pooled
        s = (1 - RIDGE) * s + RIDGE * np.diag(np.diag(s)) + floor * np.eye(k)
        low = np.linalg.cholesky(s)
        whiten.append(np.linalg.inv(low))
        log_det.append(-np.log(np.diag(low)).sum())
    prior = np.log((n + 1) / (n.sum() + 2))
    return Discriminant(mean, np.stack(whiten), np.asarray(log_det), prior)


def _vectors(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy().reshape(-1, len(STATS))


def _score_rows(model: Discriminant | None, names: list[str], measured: bool = False):
    """Batches of (..., t) to (..., x): the statistics, or with a model the score.
    With ``measured`` the last column holds the statistics and not the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if measured:
                new = pa.array(model.score(_vectors(batch.column(batch.num_columns - 1))))
                yield pa.record_batch([*batch.columns[:-1], new], names=names)
                continue
            col = text_column(batch.column(batch.num_columns - 1))
            for i, n in chunks(col):
                x = statistics(Texts(col.slice(i, n)))
                new = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())) if model is None else pa.array(model.score(x))
                yield pa.record_batch([c.slice(i, n) for c in batch.columns[:-1]] + [new], names=names)

    return run


def measure(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, stats_col: str = "stats") -> DataFrame:
    """The ``carry`` columns (all by default) of each row and the STATS of its
    whole text as ``stats_col``, which ``learn`` and ``quality_scores`` take in
    place of the text. Written once, so that both read what one pass measured."""
    rows = _by_text(docs, None, text_col, carry, stats_col, "array<double>")
    return docs.sparkSession.read.schema(rows.schema).parquet(write_scratch(rows, "statistics"))


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stats_col: str | None = None) -> Discriminant:
    """Fit on the labelled rows whose crc32(id) mod 4 is not 2, each distinct
    vector once per class; calibrate on a fifth of them. ``stats_col`` names the
    statistics of ``measure``; without it the texts are measured."""
    key = F.col(id_col).cast("string")
    lab = labels.where(F.col("quality").isin(0, 1)).select(key.alias("k"), F.col("quality").cast("int").alias("y"))
    lab = lab.where(F.col("k").isNotNull() & (F.crc32("k") % 4 != 2)).groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("y1")).where("y = y1").select("k", "y")
    if stats_col is None:
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        x = docs.select(key.alias("k"), text.alias("t")).mapInArrow(_score_rows(None, ["k", "x"]), "k string, x array<double>")
    else:
        x = docs.select(key.alias("k"), F.col(stats_col).alias("x"))
    rows = x.join(lab, "k").groupBy("y", "x").agg(F.min("k").alias("k"))
    rows = rows.select("y", "x", (F.crc32("k") % 5 == 0).alias("hold"))
    dim = len(STATS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + dim + dim * dim))
        for b in batches:
            v = _vectors(b.column(1))
            y, hold = b.column(0).to_numpy(), b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for c in (0, 1):
                u = v[(y == c) & ~hold]
                sums[c] += np.concatenate([[len(u)], u.sum(0), (u.T @ u).ravel()])
        yield pa.record_batch([pa.array([0, 1], pa.int32()), pa.array(sums.tolist(), pa.list_(pa.float64()))], names=["y", "s"])

    from quire.session import scratch_path

    path = scratch_path(spark, "labelled")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    parts = rows.mapInArrow(moments, "y int, s array<double>")
    got = parts.select("y", F.posexplode("s").alias("i", "v")).groupBy("y", "i").agg(F.sum("v").alias("v")).collect()  # 2 * 273 numbers
    sums = np.zeros((2, 1 + dim + dim * dim))
    for r in got:
        sums[r["y"], r["i"]] = r["v"]
    model = discriminant(sums[:, 0], sums[:, 1 : 1 + dim], sums[:, 1 + dim :].reshape(2, dim, dim))

    # calibration: counts of held rows per class and bin of the difference
    width = 0.5

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = model.difference(_vectors(b.column(1)))
            yield pa.record_batch([b.column(0), pa.array(np.clip(np.rint(z / width), -100, 100).astype(np.int32))], names=["y", "z"])

    got = rows.where("hold").mapInArrow(bins, "y int, z int").groupBy("y", "z").count().collect()  # at most 402 rows
    if len({r["y"] for r in got}) == 2:
        model.scale, model.shift = _platt(np.array([(r["z"] * width, r["y"], r["count"]) for r in got], float))
    return model


def _platt(rows: np.ndarray) -> tuple[float, float]:
    z, y, n = rows.T
    total = [n[y == c].sum() for c in (0, 1)]
    t = np.where(y == 1, (total[1] + 1) / (total[1] + 2), 1 / (total[0] + 2))
    x, q = np.stack([z / 10, np.ones_like(z)]), np.array([10.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(q @ x, -40, 40)))
        h = (x * (n * p * (1 - p))) @ x.T + 1e-2 * np.eye(2)
        q = q - np.clip(np.linalg.solve(h, x @ (n * (p - t)) + 1e-2 * (q - [10.0, 0.0])), -2, 2)
    return max(float(q[0] / 10), 0.01), float(q[1])


def _by_text(docs: DataFrame, model: Discriminant | None, text_col: str, carry: list[str] | None, out_col: str, kind: str, stats_col: str | None = None) -> DataFrame:
    """The ``carry`` columns and ``out_col``, of type ``kind``: see ``_score_rows``."""
    keep = [c for c in (docs.columns if carry is None else carry) if c != out_col]
    last = F.coalesce(F.col(text_col).cast("string"), F.lit("")) if stats_col is None else F.col(stats_col)
    src = docs.select(*[F.col(f"`{c}`") for c in keep], last.alias(spare(keep)))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
    return src.mapInArrow(_score_rows(model, [*keep, out_col], stats_col is not None), f"{schema}`{out_col}` {kind}")


def quality_scores(
    spark: SparkSession, docs: DataFrame, model: Discriminant, text_col: str = "text", carry: list[str] | None = None, score_col: str = "score", stats_col: str | None = None
) -> DataFrame:
    """The ``carry`` columns (all by default) and ``score_col`` of each row.

    Null and empty texts have the all-zero statistics and the score of those;
    whole texts of any length count; equal texts score alike; an empty table
    gives none. A carried column named as the score is replaced by it.
    ``stats_col`` names the statistics of ``measure``; without it the texts are
    measured.
    """
    return _by_text(docs, model, text_col, carry, score_col, "double", stats_col)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
