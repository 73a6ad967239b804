"""Jaccard join of documents on five-word shingles, candidates pruned by the
posterior of their MinHash agreement.

Texts of one shingle set are a class. Classes that share a band of MinHash
values are linked into neighbourhoods (connected, so no pair is listed), and a
neighbourhood is dealt in tiles of bounded size: every pair of blocks of its
classes meets in one task. There a pair's MinHash values are compared sixteen
at a time; with a uniform prior the similarity's posterior is a beta
distribution, and a pair whose chance to reach the threshold is under the
tolerance is dropped. The rest is verified on the whole shingle sets. A tile
returns per class its links' weight and a representative, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.components import components
from quire.llm.textarrays import GOLDEN, Texts, U, chunks, combine, fold, mix64, text_column
from quire.session import write_scratch

WORDS = 5
HASHES, BAND = 128, 4  # 32 bands: a pair at 0.8 shares none with chance 5e-8
STEP = 16
TOLERANCE = 1e-8
TILE_CLASSES, TILE_SHINGLES = 4096, 1 << 21


def shingle_sets(t: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, bounds): each text's distinct shingles, ascending. A text with
    fewer words than a shingle has one, of all its words; without words none."""
    doc, n = t.doc, len(t.bounds) - 1
    names = t.names
    m = max(len(names) - words + 1, 0)
    at = np.flatnonzero(doc[:m] == doc[words - 1 :]) if m else np.zeros(0, np.int64)
    s, d = fold(names, at, words, 1), doc[at]
    few = t.n_words
    for k in range(1, words):
        short = np.flatnonzero(few == k)
        if len(short):
            s = np.concatenate([s, fold(names, t.bounds[short], k, 40 + k)])
            d = np.concatenate([d, short])
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    if len(s):
        new = np.concatenate([[True], (s[1:] != s[:-1]) | (d[1:] != d[:-1])])
        s, d = s[new], d[new]
    return s, np.searchsorted(d, np.arange(n + 1))


def _multipliers() -> np.ndarray:
    return mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * GOLDEN) | U(1)


def minhash(s: np.ndarray, b: np.ndarray) -> np.ndarray:
    """HASHES smallest hash values per text (rows without shingles are zero)."""
    out = np.zeros((len(b) - 1, HASHES), np.uint32)
    full = np.flatnonzero(np.diff(b))
    if len(full):
        first = b[:-1][full]
        for j, a in enumerate(_multipliers()):
            out[full, j] = np.minimum.reduceat(((s ^ (a >> U(7))) * a >> U(32)).astype(np.uint32), first)
    return out


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For each prefix of STEP, 2 STEP, ... values: fewest agreements at which
    P(similarity >= threshold) is still at least the tolerance. The posterior of
    m agreements among n is Beta(m + 1, n - m + 1); its upper tail at t is the
    chance of at most m successes among n + 1 of chance t."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _profile(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = text_column(batch.column(1))
            for i, n in chunks(col):
                s, b = shingle_sets(Texts(col.slice(i, n)), words)
                size = np.diff(b)
                sums = []
                for k in (3, 5):
                    c = np.concatenate([[0], np.cumsum(combine(s, s, k))]).astype(np.uint64)
                    sums.append(pa.array((c[b[1:]] - c[b[:-1]]).view(np.int64), mask=size == 0))
                sig = minhash(s, b)
                yield pa.record_batch(
                    [batch.column(0).slice(i, n), batch.column(1).slice(i, n), *sums, pa.array(size.astype(np.int64)), pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["id", "row", "a", "b", "n", "sig"],
                )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, node): HASHES / BAND keys of each class."""
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, -1, BAND)
        key = np.zeros(sig.shape[:2], np.uint64)
        key += np.arange(sig.shape[1], dtype=np.uint64)[None, :]
        for j in range(BAND):
            key = combine(key, sig[:, :, j].astype(np.uint64), j)
        node = np.repeat(batch.column(0).to_numpy(), sig.shape[1])
        yield pa.record_batch([pa.array(key.ravel().view(np.int64)), pa.array(node)], names=["band", "node"])


def _links(x: list[np.ndarray], y: list[np.ndarray], sx: np.ndarray, sy: np.ndarray, least: list[int], num: int, den: int):
    """For each row block of x: (rows, cols) of the pairs at num / den or more."""
    nx, ny = np.array([len(v) for v in x]), np.array([len(v) for v in y])
    slab = max(1, (1 << 18) // max(len(y), 1))
    for i in range(0, len(x), slab):
        part = sx[i : i + slab]
        hits = np.zeros((len(part), len(y)), np.uint8)
        for k in range(STEP):
            hits += part[:, k, None] == sy[None, :, k]
        # the sizes alone bound the similarity
        small, large = np.minimum(nx[i : i + slab, None], ny[None, :]), np.maximum(nx[i : i + slab, None], ny[None, :])
        r, c = np.nonzero((hits >= least[0]) & (small * den >= large * num))
        m = hits[r, c].astype(np.int64)
        for q in range(1, HASHES // STEP):
            if not len(r):
                break
            cols = slice(q * STEP, (q + 1) * STEP)
            m = m + (part[r, cols] == sy[c, cols]).sum(axis=1)
            ok = m >= least[q]
            r, c, m = r[ok], c[ok], m[ok]
        if len(r):
            inter = _overlaps(x, y, r + i, c)
            ok = inter * (num + den) >= num * (nx[r + i] + ny[c])  # inter / union >= num / den
            r, c = r[ok], c[ok]
        yield r + i, c


def _overlaps(x: list[np.ndarray], y: list[np.ndarray], r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Common shingles of each pair (r, c): by membership of sorted arrays for
    few pairs, by incidence products over runs of the common shingles for many."""
    ur, r2 = np.unique(r, return_inverse=True)
    uc, c2 = np.unique(c, return_inverse=True)
    out = np.zeros(len(r), np.int64)
    if len(r) < 4 * (len(ur) + len(uc)):
        for k, (i, j) in enumerate(zip(r.tolist(), c.tolist(), strict=True)):
            a, b = (x[i], y[j]) if len(x[i]) < len(y[j]) else (y[j], x[i])
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            out[k] = (b[at] == a).sum()
        return out
    left, right = np.concatenate([x[i] for i in ur]), np.concatenate([y[j] for j in uc])
    li, rj = np.repeat(np.arange(len(ur)), [len(x[i]) for i in ur]), np.repeat(np.arange(len(uc)), [len(y[j]) for j in uc])
    common = np.intersect1d(left, right)
    la, ra = np.searchsorted(common, left), np.searchsorted(common, right)
    ok = (la < len(common)) & (common[np.minimum(la, len(common) - 1)] == left) if len(common) else np.zeros(len(left), bool)
    li, la = li[ok], la[ok]
    ok = (ra < len(common)) & (common[np.minimum(ra, len(common) - 1)] == right) if len(common) else np.zeros(len(right), bool)
    rj, ra = rj[ok], ra[ok]
    lo, ro = np.argsort(la, kind="stable"), np.argsort(ra, kind="stable")
    li, la, rj, ra = li[lo], la[lo], rj[ro], ra[ro]
    total = np.zeros((len(ur), len(uc)), np.float32)
    step = 1024
    for k in range(0, len(common), step):
        a0, a1 = np.searchsorted(la, [k, k + step])
        b0, b1 = np.searchsorted(ra, [k, k + step])
        p, q = np.zeros((len(ur), step), np.float32), np.zeros((len(uc), step), np.float32)
        p[li[a0:a1], la[a0:a1] - k] = 1
        q[rj[b0:b1], ra[b0:b1] - k] = 1
        total += p @ q.T
    return total[r2, c2].astype(np.int64)


def _tile(words: int, least: list[int], num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, block, weight = (table.column(k).to_numpy() for k in ("node", "block", "copies"))
        sets: list[np.ndarray] = []
        sigs = []
        col = text_column(table.column("text"))
        for i, n in chunks(col):
            s, b = shingle_sets(Texts(col.slice(i, n)), words)
            sigs.append(minhash(s, b))
            sets += [s[b[k] : b[k + 1]] for k in range(n)]
        sig = np.concatenate(sigs)
        blocks = np.unique(block)
        one = np.flatnonzero(block == blocks[0])
        two = one if len(blocks) == 1 else np.flatnonzero(block == blocks[1])
        alone = table.column("i")[0].as_py() != table.column("j")[0].as_py() and len(blocks) == 1
        links, label = np.zeros(len(node), np.int64), np.arange(len(node))
        if not alone:
            for r, c in _links([sets[k] for k in one], [sets[k] for k in two], sig[one], sig[two], least, num, den):
                r, c = one[r], two[c]
                other = r != c
                r, c = r[other], c[other]
                np.add.at(links, r, weight[c])
                if len(blocks) == 2:
                    np.add.at(links, c, weight[r])
                cut = np.flatnonzero(np.diff(r)) + 1
                for group in np.split(np.arange(len(r)), cut) if len(r) else ():
                    i, near = label[r[group[0]]], label[c[group]]
                    if (near != i).any():
                        joined = np.unique(np.append(near, i))
                        label[np.isin(label, joined)] = joined[0]
        return pa.table({"node": pa.array(node), "links": pa.array(links), "to": pa.array(node[label])})

    return run


def similar_documents(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (4, 5), words: int = WORDS, carry: bool = False
) -> DataFrame:
    """(id, class_id, n_links, leads) of each row, with the row itself as the
    struct ``row`` if ``carry``.

    ``n_links`` counts the other rows whose shingle sets have a Jaccard
    similarity of at least ``threshold`` (a fraction), copies counted; class_id
    is the smallest id among the rows reachable by links, and exactly one row of
    a class ``leads``. A text with fewer words than a shingle has one shingle of
    all its words; null and empty texts have none, link with nothing and lead
    themselves. Repeated rows are copies of each other; a null id sorts before
    all others; an empty table gives none; other columns aren't read, but for
    ``row``.
    """
    num, den = threshold
    least = least_matches(num / den, TOLERANCE)
    fields = docs.columns if carry else [text_col]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # 1. classes of equal shingle sets
    src = docs.select(F.col(id_col).alias("id"), text.alias("t"), F.struct(*[F.col(f"`{c}`") for c in fields]).alias("row"))
    src = src.select(F.struct("id", "row").alias("id"), "t")
    kind = src.schema["id"].dataType.simpleString()
    made = src.mapInArrow(_profile(words), f"id {kind}, row string, a long, b long, n long, sig binary")
    # rows get a number here; the text is kept once, inside the row if that is carried
    made = made.select(F.monotonically_increasing_id().alias("no"), "id.id", "id.row" if carry else F.col("row").alias("text"), "a", "b", "n", "sig")
    rows = spark.read.parquet(write_scratch(made, "profiles"))
    classes = (
        rows.where("a is not null").groupBy("a", "b")
        .agg(F.count("*").alias("copies"), F.min(F.struct("id", "no")).alias("lead"), F.max("n").alias("n"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = spark.read.parquet(write_scratch(classes, "classes"))
    # 2. neighbourhoods
    bands = classes.select("node", "sig").mapInArrow(_bands, "band long, node long")
    shared = bands.groupBy("band").agg(F.count("*").alias("c"), F.min("node").alias("low")).where("c > 1").select("band", "low")
    near = components(spark, bands.join(shared.hint("merge"), "band").select(F.col("node").alias("u"), F.col("low").alias("v")))
    near = near.join(classes.select("node", "copies", "n", F.col("lead.no").alias("no")), "node")
    near = spark.read.parquet(write_scratch(near, "near"))
    # 3. tiles
    size = near.groupBy("root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    size = size.select("root", F.greatest(F.ceil(F.col("c") / TILE_CLASSES), F.ceil(F.col("s") / TILE_SHINGLES)).cast("int").alias("tiles"))
    placed = near.join(size, "root").withColumn("block", F.pmod(F.xxhash64("node", F.lit(9)), "tiles").cast("int"))
    one = placed.select("no", "node", "root", "copies", "block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("k"))
    one = one.select("no", "node", "root", "copies", "block", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"))
    # both sides of these two joins grow with the corpus, so they are sort-merge
    # joins at any size
    texts = rows.select("no", F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")).alias("text")) if carry else rows.select("no", "text")
    told = texts.join(one.hint("merge"), "no").groupBy("root", "i", "j").applyInArrow(_tile(words, least, num, den), "node long, links long, to long")
    told = spark.read.parquet(write_scratch(told, "links"))
    # 4. classes of linked classes
    groups = components(spark, told.select(F.col("node").alias("u"), F.col("to").alias("v")))
    total = told.groupBy("node").agg(F.sum("links").alias("links"))
    every = classes.join(groups, "node", "left").join(total, "node", "left")
    every = every.select("a", "b", F.coalesce("root", "node").alias("root"), "lead", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    heads = every.groupBy("root").agg(F.min("lead").alias("head"))
    every = every.join(heads, "root").select("a", "b", "n_links", "head")
    out = rows.join(every, ["a", "b"], "left")
    own = F.col("a").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(own, F.col("id")).otherwise(F.col("head.id")).alias("class_id"),
        F.when(own, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        (own | (F.col("head.no") == F.col("no"))).alias("leads"),
        *(["row"] if carry else []),
    )
