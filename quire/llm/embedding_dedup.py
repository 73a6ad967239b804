"""Near-duplicate embeddings by a robust-pruned flat graph.

1. Equal vectors are one class, searched once and counted with its size.
2. Classes of one length are dealt to overlapping shards: each goes to its nearest few of up
   to 64 well separated centres (fitted on a bounded sample); a shard that is
   still large is split again in the same way, and one that can't be split, a
   dense cluster, is dealt in tiles, every pair of blocks in one task.
3. Each tile builds a graph: a node's candidates, its nearest and some random
   ones, are pruned so that no kept neighbour is much nearer to another kept one;
   edges go both ways. A node's lists from all its tiles are united.
4. Each tile searches its nodes in the united graph: greedily with a beam from
   the medoid and the node itself, then outwards from all that lies in range.
   Pairs are verified in double precision. A pair is judged in the first shard
   that both share, and only links' weights and representatives leave a task.
5. Recall is audited by brute force for a bounded set of queries, each counted
   alike; below the target the index is built again with a wider overlap and
   beam, and if that doesn't reach it either, all pairs are compared in tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.components import components
from quire.session import write_scratch

THRESHOLD = 0.95
CENTRES, SAMPLE = 64, 4096  # per split; the sample's bound
APART = 0.7  # largest cosine of two centres
SHARD = 16384  # a larger shard is split again
TILE = 2048  # classes of a block
LEVELS = 4
NEAREST, RANDOM, DEGREE, ALPHA = 40, 12, 24, 1.2
SLACK = 0.04  # how far below the threshold the search still expands
AUDIT, TARGET = 1024, 0.99
TRIES = 2


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(n > 0, n, 1)


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def centres(v: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` centres, no two closer than APART: farthest points first, then
    spherical k-means; a centre that drifts to another is dropped."""
    v = _unit(v)
    picked = [0]
    near = v @ v[0]
    while len(picked) < k:
        i = int(near.argmin())
        if near[i] > APART:
            break
        picked.append(i)
        near = np.maximum(near, v @ v[i])
    c = v[picked]
    for _ in range(6):
        at = (v @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, v)
        c = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-9, _unit(sums), c)
    kept: list[np.ndarray] = []
    for x in c:
        if not kept or max(x @ y for y in kept) <= APART:
            kept.append(x)
    return np.stack(kept)


def _split(spark: SparkSession, rows: DataFrame, level: int, overlap: int) -> DataFrame:
    """Rows (node, weight, v, shard) of large shards dealt to their parts."""
    sizes = rows.groupBy("shard").agg(F.count("*").alias("c"))
    share = F.col("c") / F.lit(SAMPLE / 2)  # about half the bound of each shard
    picked = rows.join(sizes, "shard").where(F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1 << 30)) * share <= (1 << 30)).select("shard", "node", "v")

    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("node").to_numpy())[:SAMPLE]
        c = centres(_matrix(table.column("v"))[order], CENTRES)
        return pa.table({"shard": table.column("shard").slice(0, 1), "centres": pa.array([c.tobytes()], pa.binary())})

    fitted = picked.groupBy("shard").applyInArrow(fit, "shard string, centres binary")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            shard, packed = b.column(3).to_pylist(), b.column(4).to_pylist()
            parts: list[list[str]] = [[]] * b.num_rows
            for s in set(shard):
                i = np.array([k for k, x in enumerate(shard) if x == s])
                v = _unit(_matrix(b.column(2).take(pa.array(i))))  # of one length in a shard
                c = np.frombuffer(packed[i[0]], np.float64).reshape(-1, v.shape[1])
                m = min(overlap, len(c))
                best = np.argpartition(-(v @ c.T), m - 1, axis=1)[:, :m]
                for k, near in zip(i, best, strict=True):
                    parts[k] = [f"{s}.{x}" for x in sorted(near.tolist())]
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(parts, pa.list_(pa.string()))], names=["node", "weight", "v", "parts"])

    # one short row per shard; a shard's own rows may be many, and are split
    dealt = rows.select("node", "weight", "v", "shard").join(fitted, "shard").select("node", "weight", "v", "shard", "centres")
    dealt = dealt.mapInArrow(deal, "node long, weight long, v array<double>, parts array<string>")
    return dealt.select("node", "weight", "v", F.explode("parts").alias("shard"))


def _graph(v: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of the pruned graph, both ways."""
    m = len(v)
    if m < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rng = np.random.default_rng(int(node.min()) % (1 << 32) + m)
    k = min(NEAREST, m - 1)
    src, dst = [], []
    for i in range(0, m, 256):
        part = np.arange(i, min(i + 256, m))
        s = v[part] @ v.T
        s[np.arange(len(part)), part] = -2
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        far = rng.integers(0, m, (len(part), RANDOM))
        cand = np.concatenate([near, far], axis=1)
        sim = np.take_along_axis(s, cand, axis=1)
        order = np.argsort(-sim, axis=1, kind="stable")
        cand, sim = np.take_along_axis(cand, order, axis=1), np.take_along_axis(sim, order, axis=1)
        dist = np.sqrt(np.maximum(2 - 2 * sim, 0))
        cv = v[cand]
        between = np.sqrt(np.maximum(2 - 2 * (cv @ cv.transpose(0, 2, 1)), 0))
        alive = cand != part[:, None]
        count = np.zeros(len(part), np.int64)
        kept = np.zeros(cand.shape, bool)
        for j in range(cand.shape[1]):
            take = alive[:, j] & (count < DEGREE)
            kept[:, j] = take
            count += take
            # a candidate much nearer to the kept one than to the node goes
            alive &= ~(take[:, None] & (ALPHA * between[:, j, :] <= dist))
        r, c = np.nonzero(kept)
        src.append(part[r])
        dst.append(cand[r, c])
    a, b = np.concatenate(src), np.concatenate(dst)
    code = np.unique(np.concatenate([a * m + b, b * m + a]))
    return code // m, code % m


def _build(table: pa.Table) -> pa.Table:
    node = table.column("node").to_numpy()
    v = _unit(_matrix(table.column("v"))).astype(np.float32)
    a, b = _graph(v, node)
    edges = np.searchsorted(a, np.arange(len(node) + 1))
    return pa.table({"node": pa.array(node), "near": pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(node[b]))})


def _spread(q: np.ndarray, at: np.ndarray, first: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, neighbour) for every neighbour of each (query, node)."""
    n = first[at + 1] - first[at]
    start = np.repeat(first[at] - (np.cumsum(n) - n), n)
    return np.repeat(q, n), to[start + np.arange(int(n.sum()))]


def _search(v: np.ndarray, first: np.ndarray, to: np.ndarray, beam: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, nodes) in range of each other, some queries at a time."""
    m = len(v)
    medoid = int((v @ v.mean(axis=0)).argmax())
    for i in range(0, m, 256):
        qs = np.arange(i, min(i + 256, m))
        n = len(qs)
        x = v[qs]
        seen = np.zeros((n, m), bool)
        rows = np.arange(n)
        ids = np.full((n, beam), -1)
        sims = np.full((n, beam), -2, np.float32)
        done = np.ones((n, beam), bool)
        ids[:, 0], ids[:, 1] = medoid, qs
        sims[:, 0], sims[:, 1] = x @ v[medoid], 1.0
        done[:, :2] = False
        same = qs == medoid
        ids[same, 1], done[same, 1], sims[same, 1] = -1, True, -2
        seen[rows, medoid] = True
        seen[rows, qs] = True
        got_q, got_n = [], []
        while True:
            score = np.where(done, -3, sims)
            best = score.argmax(axis=1)
            live = np.flatnonzero(score[rows, best] > -3)
            if not len(live):
                break
            at = ids[live, best[live]]
            done[live, best[live]] = True
            q, t = _spread(live, at, first, to)
            new = ~seen[q, t]
            q, t = q[new], t[new]
            if not len(q):
                continue
            seen[q, t] = True
            s = np.einsum("ij,ij->i", x[q], v[t])
            hit = s >= threshold - SLACK
            got_q.append(q[hit])
            got_n.append(t[hit])
            # the best `beam` of the old and the new ones of each query
            start = np.searchsorted(q, live)
            width = int(np.diff(np.append(start, len(q))).max())
            slot = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
            new_ids, new_sims = np.full((len(live), width), -1), np.full((len(live), width), -2, np.float32)
            r = np.searchsorted(live, q)
            new_ids[r, slot], new_sims[r, slot] = t, s
            all_ids = np.concatenate([ids[live], new_ids], axis=1)
            all_sims = np.concatenate([sims[live], new_sims], axis=1)
            all_done = np.concatenate([done[live], new_ids < 0], axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, top, axis=1)
            sims[live] = np.take_along_axis(all_sims, top, axis=1)
            done[live] = np.take_along_axis(all_done, top, axis=1)
        # outwards from what is in range, until nothing new is
        q = np.concatenate([*got_q, rows])
        t = np.concatenate([*got_n, qs])
        every_q, every_t = [q], [t]
        while len(q):
            q, t = _spread(q, t, first, to)
            code = np.unique(q * m + t)
            q, t = code // m, code % m
            new = ~seen[q, t]
            q, t = q[new], t[new]
            seen[q, t] = True
            hit = np.einsum("ij,ij->i", x[q], v[t]) >= threshold - SLACK
            q, t = q[hit], t[hit]
            every_q.append(q)
            every_t.append(t)
        yield qs[np.concatenate(every_q)], np.concatenate(every_t)


def _find(threshold: float, beam: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, weight, block = (table.column(k).to_numpy() for k in ("node", "weight", "block"))
        shard = table.column("shard")[0].as_py()
        cross = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        exact = _unit(_matrix(table.column("v")))
        v = exact.astype(np.float32)
        m = len(node)
        order = np.argsort(node)
        near = table.column("near").combine_chunks()
        size = np.diff(near.offsets.to_numpy())
        a, b = np.repeat(np.arange(m), size), near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(node[order], b), m - 1)
        here = node[order][at] == b
        a, b = a[here], order[at[here]]
        first = np.searchsorted(a, np.arange(m + 1))
        # numbers for the shards that nodes share with this one
        shards = [sorted(s) for s in table.column("shards").to_pylist()]
        before = [frozenset(x for x in s if x < shard) for s in shards]
        kinds: dict[frozenset, int] = {}
        kind = np.array([kinds.setdefault(s, len(kinds)) for s in before])
        meet = np.array([[bool(p & q) for q in kinds] for p in kinds]).reshape(len(kinds), len(kinds))
        found = []
        for q, t in _search(v, first, b, beam, threshold):
            ok = (q != t) & ~meet[kind[q], kind[t]]
            if cross:
                ok &= block[q] != block[t]
            q, t = q[ok], t[ok]
            sim = np.einsum("ij,ij->i", exact[q], exact[t])
            ok = sim >= threshold
            found.append(np.minimum(q, t)[ok] * m + np.maximum(q, t)[ok])
        code = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        p, q = code // m, code % m
        links = np.bincount(p, weights=weight[q], minlength=m) + np.bincount(q, weights=weight[p], minlength=m)
        label = np.arange(m)
        while True:  # smallest number reachable
            low = label.copy()
            np.minimum.at(low, p, label[q])
            np.minimum.at(low, q, label[p])
            low = low[low]
            if (low == label).all():
                break
            label = low
        return pa.table({"node": pa.array(node), "links": pa.array(links.astype(np.int64)), "to": pa.array(node[label])})

    return run


def _valid(v) -> F.Column:
    x = F.col(v)
    whole = F.coalesce(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False))
    return whole & F.coalesce(F.exists(x, lambda e: e != 0), F.lit(False))


def near_duplicates(
    spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, overlap: int = 3, beam: int = 24
) -> DataFrame:
    """(id, n_links, component_id, kept) of each row.

    Vectors that are null, zero or hold null or non-finite components link with
    nothing; others with those of their own length. ``n_links`` counts the other rows at a cosine of at least
    ``threshold``, equal rows included; component_id is the smallest id
    reachable. An empty table gives none; other columns aren't read. Search is
    approximate but audited (see above); no pair below the threshold is linked.
    """
    src = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    classes = src.where(_valid("v")).groupBy("v").agg(F.count("*").alias("weight"), F.min("id").alias("low"))
    classes = spark.read.parquet(write_scratch(classes.withColumn("node", F.monotonically_increasing_id()), "vectors"))
    nodes = classes.select("node", "weight", "v")
    asked = nodes.orderBy(F.xxhash64("node", F.lit(6))).limit(AUDIT).collect()
    for k in range(TRIES):
        told = _linked(spark, nodes, threshold, overlap + k, beam << k)
        if _recall(nodes, told, asked, threshold) >= TARGET:
            break
    else:
        told = _compared(spark, nodes, threshold)
    groups = components(spark, told.select(F.col("node").alias("u"), F.col("to").alias("v")))
    total = told.groupBy("node").agg(F.sum("links").alias("links"))
    every = classes.join(groups, "node", "left").join(total, "node", "left")
    every = every.select("v", "low", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    heads = every.groupBy("root").agg(F.min("low").alias("head"))
    every = every.join(heads, "root").select("v", "n_links", "head")
    out = src.withColumn("v", F.when(_valid("v"), F.col("v"))).join(every, "v", "left")
    head = F.coalesce("head", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), head.alias("component_id"), F.coalesce(F.col("id") == head, F.lit(True)).alias("kept"))


def _linked(spark: SparkSession, nodes: DataFrame, threshold: float, overlap: int, beam: int) -> DataFrame:
    """(node, links, to) of every node and tile, written."""
    rows = nodes.select("node", "weight", "v", F.size("v").cast("string").alias("shard"))
    done = None
    level = 0
    while True:
        rows = spark.read.parquet(write_scratch(_split(spark, rows, level, overlap), f"shards{level}"))
        level += 1
        sizes = rows.groupBy("shard").agg(F.count("*").alias("c"))
        large = sizes.where(F.col("c") > SHARD).select("shard")
        if level == LEVELS or not large.take(1):
            break
        small = rows.join(large, "shard", "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, "shard").select(*rows.columns)
    rows = rows if done is None else done.unionByName(rows)
    tiles = rows.groupBy("shard").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    lists = rows.groupBy("node").agg(F.collect_set("shard").alias("shards"))
    placed = rows.join(tiles, "shard").join(lists, "node").withColumn("block", F.pmod(F.xxhash64("node", "shard"), "tiles").cast("int"))
    placed = spark.read.parquet(write_scratch(placed, "placed"))
    dealt = placed.select("node", "weight", "v", "shard", "shards", "block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("k"))
    dealt = dealt.withColumns({"i": F.least("block", "k"), "j": F.greatest("block", "k")}).drop("k")
    near = dealt.select("node", "v", "shard", "i", "j").groupBy("shard", "i", "j").applyInArrow(_build, "node long, near array<long>")
    lists = near.select("node", F.explode("near").alias("to")).distinct().groupBy("node").agg(F.collect_list("to").alias("near"))
    graph = spark.read.parquet(write_scratch(lists, "graph"))
    found = dealt.join(graph, "node", "left").withColumn("near", F.coalesce("near", F.array().cast("array<long>")))
    found = found.groupBy("shard", "i", "j").applyInArrow(_find(threshold, beam), "node long, links long, to long")
    return spark.read.parquet(write_scratch(found, "found"))


def _compared(spark: SparkSession, nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, to) of every node and tile by comparing all pairs of blocks
    of vectors of one length: the exact way where the index misses its target."""
    sizes = nodes.groupBy(F.size("v").alias("d")).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    placed = nodes.join(sizes, F.size("v") == F.col("d")).withColumn("block", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    dealt = placed.select("d", "node", "weight", "v", "block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("k"))
    dealt = dealt.withColumns({"i": F.least("block", "k"), "j": F.greatest("block", "k")}).drop("k")

    def run(table: pa.Table) -> pa.Table:
        node, weight, block = (table.column(k).to_numpy() for k in ("node", "weight", "block"))
        cross = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        v, links, label = _unit(_matrix(table.column("v"))), np.zeros(len(node), np.int64), np.arange(len(node))
        pairs = []
        for at in range(0, len(node), 256):
            hit = v[at : at + 256] @ v.T >= threshold
            if cross:
                hit &= block[at : at + 256, None] != block
            q, t = np.nonzero(hit)
            pairs.append(np.stack([q + at, t])[:, q + at != t])
        q, t = np.concatenate(pairs, axis=1)
        np.add.at(links, q, weight[t])
        while True:  # smallest number reachable
            low = label.copy()
            np.minimum.at(low, q, label[t])
            low = low[low]
            if (low == label).all():
                break
            label = low
        return pa.table({"node": pa.array(node), "links": pa.array(links), "to": pa.array(node[label])})

    found = dealt.groupBy("d", "i", "j").applyInArrow(run, "node long, links long, to long")
    return spark.read.parquet(write_scratch(found, "compared"))


def _recall(nodes: DataFrame, told: DataFrame, asked: list, threshold: float) -> float:
    """Mean share of its true links that the index found for each of the audit's
    queries that has any (at most AUDIT vectors, held by every task): a member of
    a large group counts as much as one of a pair."""
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {len(r["v"]) for r in asked}:
        mine = [r for r in asked if len(r["v"]) == d]
        queries[d] = np.array([r["node"] for r in mine]), _unit(np.array([r["v"] for r in mine]))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {d: np.zeros(len(ids), np.int64) for d, (ids, _) in queries.items()}
        for b in batches:
            length = np.diff(b.column(2).offsets.to_numpy())
            for d in set(length.tolist()) & queries.keys():
                i, (ids, q) = np.flatnonzero(length == d), queries[d]
                hit = (_unit(_matrix(b.column(2).take(pa.array(i)))) @ q.T >= threshold) & (b.column(0).to_numpy()[i, None] != ids)
                total[d] += (hit * b.column(1).to_numpy()[i, None]).sum(axis=0)
        for d, (ids, _) in queries.items():
            yield pa.record_batch([pa.array(ids), pa.array(total[d])], names=["node", "links"])

    true = nodes.mapInArrow(brute, "node long, links long").groupBy("node").agg(F.sum("links").alias("true")).where(F.col("true") > 0)
    found = told.groupBy("node").agg(F.sum("links").alias("found"))
    share = F.least(F.coalesce("found", F.lit(0)), F.col("true")) / F.col("true")
    r = true.join(found, "node", "left").agg(F.avg(share)).first()
    return 1.0 if r[0] is None else r[0]
