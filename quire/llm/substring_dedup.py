"""Removal of repeated passages by recompression.

Each text's words are rewritten in rounds: a run round names maximal runs of
one symbol, a pair round splits the alphabet in two halves by a bit of the
symbol's name and names every adjacent (left half, right half) pair. A name is
a hash of its parts, so it is the same everywhere without a dictionary. Every
new symbol carries the span of words that its making depended on; inside a
repeated window of words, each symbol whose span lies in the window comes out
the same in every copy. A window's anchor is, among its symbols of LONG words or
more, the one of the largest name (in lack of any, the longest symbol), so equal
windows have equal anchors and neighbouring windows mostly share theirs.

1. The anchors of all windows are counted over the corpus; an anchor made at
   one place only proves its windows unique. This leaves few windows.
2. Those are verified: two folds of their words' names are counted over the corpus.
3. Words under a window counted twice or more are removed.

Counts are combined before they are shuffled, the join back to the rows is an
ordinary one that Spark splits where a key is hot, and no window meets another
in pairs. Texts that are equal as a whole are settled by their class count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.textarrays import Texts, U, chunks, combine, fold, mix64, text_column

ROUNDS = ("run", "pair", "pair", "pair", "pair", "pair", "pair")
LONG = 6
LENGTH_SHIFT = U(58)  # an anchor's name: length in words up to LONG, 58 bits of the symbol's


def anchors(names: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, anchor) of every group of windows of one anchor occurrence;
    a group is the windows from its position up to the next group's or to the
    end of its text's windows. ``bounds`` limits the words of each text."""
    n = len(names)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    lo = np.arange(n)
    hi = lo + 1
    first, last = bounds[:-1][doc] - 1, bounds[1:][doc] + 1  # spans that reach past a text
    at, name, size = lo.copy(), names, np.ones(n, np.int64)
    made = [[] for _ in range(width + 1)]  # by span: (lo, key)

    def note(lo_, hi_, size_, name_, in_doc) -> None:
        span = hi_ - lo_
        ok = (span <= width) & (lo_ > first[in_doc]) & (hi_ < last[in_doc])
        lo_, span = lo_[ok], span[ok]
        key = (np.minimum(size_[ok], LONG).astype(np.uint64) << LENGTH_SHIFT) | (name_[ok] >> U(6))
        order = np.argsort(span.astype(np.int8), kind="stable")
        lo_, key, edges = lo_[order], key[order], np.searchsorted(span[order], np.arange(width + 2))
        for s in range(1, width + 1):
            if edges[s] < edges[s + 1]:
                made[s].append((lo_[edges[s] : edges[s + 1]], key[edges[s] : edges[s + 1]]))

    note(lo, hi, size, name, at)
    for k, kind in enumerate(ROUNDS):
        m = len(name)
        if m < 2:
            break
        d = doc[at]
        mate = d[1:] == d[:-1]
        prev_lo = np.concatenate([[0], lo[:-1]])
        prev_lo[1:][~mate] = first[at[1:]][~mate]
        prev_lo[0] = first[at[0]]
        next_hi = np.concatenate([hi[1:], [0]])
        next_hi[:-1][~mate] = last[at[:-1]][~mate]
        next_hi[-1] = last[at[-1]]
        if kind == "run":
            same = mate & (name[1:] == name[:-1])
            head = np.concatenate([[True], ~same])
            i = np.flatnonzero(head)
            j = np.concatenate([i[1:], [m]])
            times = j - i
            lo = np.minimum(np.minimum.reduceat(lo, i), prev_lo[i])
            hi = np.maximum(np.maximum.reduceat(hi, i), next_hi[j - 1])
            new = times > 1
            name = np.where(new, combine(name[i], times.astype(np.uint64), 100 + k), name[i])
            size = np.add.reduceat(size, i)
            at = at[i]
        else:
            right = (mix64(name + U(1 + k)) & U(1)).astype(bool)
            pair = mate & ~right[:-1] & right[1:]
            keep = np.concatenate([[True], ~pair])
            new = np.concatenate([pair, [False]])
            # an unpaired symbol depended on the neighbour it could have paired with
            wide_lo = np.where(right, np.minimum(lo, prev_lo), lo)
            wide_hi = np.where(right, hi, np.maximum(hi, next_hi))
            p = np.flatnonzero(new)
            wide_lo[p], wide_hi[p] = np.minimum(lo[p], lo[p + 1]), np.maximum(hi[p], hi[p + 1])
            grown, long = name.copy(), size.copy()
            grown[p] = combine(name[p], name[p + 1], k)
            long[p] += size[p + 1]
            i = np.flatnonzero(keep)
            lo, hi, name, size, at, new = wide_lo[i], wide_hi[i], grown[i], long[i], at[i], new[i]
        p = np.flatnonzero(new)
        note(lo[p], hi[p], size[p], name[p], at[p])

    # best[p]: the best symbol inside [p, p + s), for growing s; here[p]: the
    # best one whose span begins at p
    best, here = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for s in range(1, width + 1):
        if s > 1:
            best[:-1] = np.maximum(best[:-1], best[1:])
        for p, key in made[s]:
            np.maximum.at(best, p, key)
            np.maximum.at(here, p, key)
    windows = np.arange(n) + width <= bounds[1:][doc] if n else np.zeros(0, bool)
    new = windows.copy()
    new[1:] &= ~(windows[:-1] & (doc[1:] == doc[:-1]) & (best[1:] == best[:-1]) & (best[:-1] != here[:-1]))
    p = np.flatnonzero(new)
    return p, best[p]


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """``values`` as one list per text; ``owner`` ascends."""
    off = pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(off, pa.array(values))


def _anchor_rows(width: int):
    """Per text: anchors made once in this piece of the input with the windows
    they stand for, and those made again here: they are known to be repeated, so
    their windows need no join and each is listed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, col = batch.column(0), text_column(batch.column(1))
            for i, n in chunks(col):
                t = Texts(col.slice(i, n))
                p, a = anchors(t.names, t.bounds, width)
                owner = np.searchsorted(t.bounds, p, side="right") - 1
                first = (p - t.bounds[owner]).astype(np.int32)
                end = (t.n_words - width + 1)[owner].astype(np.int32)
                stop = end.copy()
                stop[:-1] = np.where(owner[1:] == owner[:-1], first[1:], end[:-1])
                _, lead, inv, count = np.unique(a, return_index=True, return_inverse=True, return_counts=True)
                again = count[inv] > 1
                lead = np.sort(lead[count > 1])
                one = ~again
                ranges = np.stack([first, stop], axis=1)
                yield pa.record_batch(
                    [
                        keys.slice(i, n), _lists(a[one].view(np.int64), owner[one], n), _lists(first[one], owner[one], n), _lists(stop[one], owner[one], n),
                        _lists(a[lead].view(np.int64), owner[lead], n), _lists(ranges[again].ravel(), np.repeat(owner[again], 2), n),
                    ],
                    names=["key", "anchor", "from", "to", "sure", "own"],
                )

    return run


def _kept_digest(t: Texts, i: int, keep: np.ndarray | None, as_text: bool) -> str:
    b, e = t.bounds[i], t.bounds[i + 1]
    idx = range(b, e) if keep is None else (b + np.flatnonzero(keep)).tolist()
    s, f, d = t.starts, t.ends, t.data
    kept = b" ".join([d[s[k] : f[k]].tobytes() for k in idx]) if len(idx) < 64 else _joined(t, np.asarray(idx))
    return kept.decode("utf-8", "replace") if as_text else hashlib.sha256(kept).hexdigest()


def _joined(t: Texts, idx: np.ndarray) -> bytes:
    """Words ``idx`` joined by spaces, copied in one gather."""
    size = t.ends[idx] - t.starts[idx] + 1
    first = np.cumsum(size) - size
    src = np.arange(int(size.sum())) + np.repeat(t.starts[idx] - first, size)
    out = t.data[src]
    out[first + size - 1] = 0x20
    return out[:-1].tobytes()


def _spread_ranges(x: np.ndarray) -> np.ndarray:
    """All positions of the (from, to) rows, ascending, each once."""
    grow = x[:, 1] - x[:, 0]
    return np.unique(np.repeat(x[:, 0] - (np.cumsum(grow) - grow), grow) + np.arange(int(grow.sum())))


def _under(at: np.ndarray, words: int, width: int) -> np.ndarray:
    """Words not under any window that starts at ``at``."""
    step = np.zeros(words + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    return np.cumsum(step)[:-1] == 0


def _verify_rows(width: int, as_text: bool):
    """Per row: its result where it is settled, else its text and its windows
    known to be repeated; with both, the 128-bit names of the windows to count:
    ``names`` (and ``at``) of those seen once in this piece, ``sure`` of the
    repeated ones, each once. A whole text that has copies is told once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for batch in batches:
            col = text_column(batch.column(2))
            copies, spots, owns = (batch.column(k) for k in (3, 4, 5))
            for i, n in chunks(col):
                t = Texts(col.slice(i, n))
                words = t.n_words
                cid = batch.column(1).slice(i, n).to_numpy()
                many = (copies.slice(i, n).to_numpy() > 1) & (words >= width)
                spot, own = spots.slice(i, n).to_pylist(), owns.slice(i, n).to_pylist()
                at: list[np.ndarray] = []
                for r in range(n):
                    x = [(q["from"], q["to"]) for q in spot[r] or ()]
                    x = np.array(x, np.int64).reshape(-1, 2)
                    if own[r]:
                        x = np.concatenate([x, np.array(own[r], np.int64).reshape(-1, 2)])
                    skip = many[r] and int(cid[r]) in told
                    at.append(np.zeros(0, np.int64) if skip or not len(x) else _spread_ranges(x))
                    if many[r]:
                        told.add(int(cid[r]))
                owner = np.repeat(np.arange(n), [len(x) for x in at])
                rel = np.concatenate(at)
                p = rel + t.bounds[owner]
                a, b = fold(t.names, p, width, 11), fold(t.names, p, width, 23)
                order = np.lexsort((b, a))
                head = np.ones(len(p), bool)
                head[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
                group = np.cumsum(head) - 1
                count = np.bincount(group, weights=1 + many[owner[order]]) if len(p) else np.zeros(0)
                known = np.zeros(len(p), bool)
                known[order] = count[group] > 1
                lead = np.zeros(len(p), bool)
                lead[order[head]] = True
                pack = np.stack([a, b], axis=1)
                out = {k: [] for k in ("n_removed", "kept", "text", "names", "at", "sure", "hits")}
                edges = np.searchsorted(owner, np.arange(n + 1))
                for r in range(n):
                    own_r = slice(edges[r], edges[r + 1])
                    k, q = known[own_r], rel[own_r]
                    settled = many[r] or k.all()
                    keep = np.zeros(words[r], bool) if many[r] else _under(q, int(words[r]), width) if len(q) else None
                    out["n_removed"].append((0 if keep is None else int((~keep).sum())) if settled else None)
                    out["kept"].append(_kept_digest(t, r, keep, as_text) if settled else None)
                    out["text"].append(None if settled else col[i + r].as_py())
                    out["hits"].append(None if settled else q[k].astype(np.int32).tobytes())
                    new = ~k
                    out["names"].append(pack[own_r][new].tobytes() if new.any() else None)
                    out["at"].append(q[new].astype(np.int32).tobytes() if new.any() else None)
                    first = k & lead[own_r]
                    out["sure"].append(pack[own_r][first].tobytes() if first.any() else None)
                cols = [batch.column(0).slice(i, n), batch.column(1).slice(i, n), pa.array(words.astype(np.int64)), pa.array(out["n_removed"], pa.int64())]
                cols += [pa.array(out["kept"], pa.string()), pa.array(out["text"], pa.string())]
                cols += [pa.array(out[k], pa.binary()) for k in ("names", "at", "sure", "hits")]
                yield pa.record_batch(cols, names=["id", "cid", "n_words", "n_removed", "kept", "text", "names", "at", "sure", "hits"])

    return run


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, at, a, b): a row per window to be verified, at -1 for known ones."""
    for batch in batches:
        for k, sure in ((1, False), (3, True)):
            raw = [x or b"" for x in batch.column(k).to_pylist()]
            count = [len(x) // 16 for x in raw]
            names = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
            if not len(names):
                continue
            at = np.full(len(names), -1, np.int32) if sure else np.frombuffer(b"".join(x or b"" for x in batch.column(2).to_pylist()), np.int32)
            cid = np.repeat(batch.column(0).to_numpy(), count)
            yield pa.record_batch([pa.array(cid), pa.array(at), pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy())], names=["cid", "at", "a", "b"])


def _cut_rows(width: int, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col, own, hits = text_column(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, n in chunks(col):
                t = Texts(col.slice(i, n))
                removed, kept = [], []
                for r in range(n):
                    at = np.concatenate([np.frombuffer(own[i + r], np.int32), np.asarray(hits[i + r] or [], np.int32)]).astype(np.int64)
                    keep = _under(at, int(t.n_words[r]), width)
                    removed.append(int((~keep).sum()))
                    kept.append(_kept_digest(t, r, keep, as_text))
                yield pa.record_batch(
                    [batch.column(0).slice(i, n), pa.array(t.n_words.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["id", "n_words", "n_removed", "kept"],
                )

    return run


def dedup_substrings(
    spark: SparkSession, docs: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text", kept_as: str = "text"
) -> DataFrame:
    """(id, n_words, n_removed, kept) of each row.

    A window is ``width`` (2 to 63) consecutive words of a text; every word under
    a window whose words also start anywhere else, in the same text too, is
    removed. ``kept`` is the other words joined by one space, or with
    ``kept_as="sha256"`` its digest. Null and empty texts have no words; texts
    under ``width`` words lose none; repeated rows are copies of each other, so
    they lose all when long enough; an empty table gives an empty result; other
    columns aren't read. Window names have 128 bits; no other step can err.
    """
    from quire.session import remove_path, write_scratch

    if not 2 <= width <= 63:
        raise ValueError("width must be 2 to 63")
    as_text = kept_as == "text"
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), F.md5(text).alias("key"), text.alias("t"))

    made = src.select("key", "t").mapInArrow(_anchor_rows(width), "key string, anchor array<long>, from array<int>, to array<int>, sure array<long>, own array<int>")
    path = write_scratch(made.withColumn("no", F.monotonically_increasing_id()), "anchors", "zstd")
    rows = spark.read.parquet(path)
    # an anchor is repeated if it was made at two places, or in one piece again
    listed = rows.select(F.explode(F.concat("anchor", "sure", "sure")).alias("anchor"))
    seen = listed.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    groups = rows.select("no", F.explode(F.arrays_zip("anchor", "from", "to")).alias("g")).select("no", "g.*")
    spots = groups.join(seen, "anchor").groupBy("no").agg(F.collect_list(F.struct("from", "to")).alias("spots"))
    # equal texts are a class; its first row's spots stand for all
    classes = rows.groupBy("key").agg(F.count("*").alias("copies"), F.min(F.struct("no", "own")).alias("one"))
    known = classes.select("key", "copies", F.col("one.no").alias("cid"), "one.own").join(spots, F.col("cid") == F.col("no"), "left").drop("no")
    spots_path = write_scratch(known, "spots", "zstd")
    known = spark.read.parquet(spots_path)
    remove_path(spark, path)  # the anchors aren't needed any more

    checked = src.join(known, "key").select("id", "cid", "t", "copies", "spots", "own").mapInArrow(
        _verify_rows(width, as_text),
        f"id {id_type}, cid long, n_words long, n_removed long, kept string, text string, names binary, at binary, sure binary, hits binary",
    )
    rows = spark.read.parquet(write_scratch(checked, "windows", "zstd"))  # holds texts
    remove_path(spark, spots_path)
    asked = rows.where("names is not null or sure is not null").select("cid", "names", "at", "sure")
    windows = asked.mapInArrow(_window_rows, "cid long, at int, a long, b long")
    twice = windows.groupBy("a", "b").agg(F.sum(F.when(F.col("at") < 0, 2).otherwise(1)).alias("c")).where("c > 1").select("a", "b")
    # only rows that aren't settled look up their windows
    open_rows = rows.where("text is not null and names is not null").select("cid", "names", "at", F.lit(None).cast("binary").alias("sure"))
    wanted = open_rows.mapInArrow(_window_rows, "cid long, at int, a long, b long")
    hits = wanted.join(twice, ["a", "b"]).groupBy("cid").agg(F.collect_list("at").alias("found"))
    hits = spark.read.parquet(write_scratch(hits, "hits", "zstd"))
    cut = rows.where("text is not null").select("id", "cid", "text", F.col("hits").alias("own")).join(hits, "cid", "left")
    cut = cut.select("id", "text", "own", "found").mapInArrow(_cut_rows(width, as_text), f"id {id_type}, n_words long, n_removed long, kept string")
    done = rows.where("text is null").select("id", "n_words", "n_removed", "kept")
    return done.unionByName(cut).withColumnRenamed("id", id_col)
