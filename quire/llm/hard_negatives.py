"""Hard negatives by exact integer products, multiplied by Strassen's recursion.

Vectors become integers. Anchors and candidates are dealt by hash to blocks, and
each pair of blocks is a tile of bounded size, so the work is spread over as
many tasks as there are tiles, whatever labels or scores are common. A tile's
scores are a product of int64 matrices: halved in all three dimensions (odd ones
are padded by zeros), seven products in place of eight, exact as additions of
int64 are exact modulo 2^64.

Pass 1 multiplies the rows of equal label and keeps a heap of the best positives
per anchor; pass 2 multiplies all rows and keeps a heap of the best negatives for
the score window of each positive. Heaps of the same anchor are merged by Spark:
each task keeps the best of its own before the shuffle, and of all after it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.ship import ship
from quire.session import write_scratch

LEAF = 16
ANCHORS, CANDIDATES = 4096, 8192  # rows of a tile's sides
STRIP = 512  # anchors whose scores are held at once
LIMIT = 1 << 56  # scores beyond are taken as this
NONE = np.int64(-(1 << 62))


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two integer matrices of any shape."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = _padded(a, m % 2, k % 2), _padded(b, k % 2, n % 2)
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1, p2 = strassen(a11 + a22, b11 + b22), strassen(a21 + a22, b11)
    p3, p4 = strassen(a11, b12 - b22), strassen(a22, b21 - b11)
    p5, p6 = strassen(a11 + a12, b22), strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * r, 2 * t), p1.dtype)
    out[:r, :t], out[:r, t:] = p1 + p4 - p5 + p7, p3 + p5
    out[r:, :t], out[r:, t:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def _padded(x: np.ndarray, rows: int, cols: int) -> np.ndarray:
    out = np.zeros((x.shape[0] + rows, x.shape[1] + cols), x.dtype)
    out[: x.shape[0], : x.shape[1]] = x
    return out


def scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``c``. Where they could
    pass LIMIT the same recursion runs on integers of any size, then they are cut
    to it."""

    def most(x: np.ndarray) -> int:
        return max(int(x.max()), -int(x.min())) if x.size else 0

    if a.shape[1] * most(a) * most(c) < LIMIT:
        return strassen(a, c.T)
    big = strassen(a.astype(object), c.astype(object).T)
    return np.clip(big, -LIMIT, LIMIT).astype(np.int64)


def best(table: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` largest entries of each row, best first, ties
    by column; entries of NONE are none."""
    if not table.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = np.partition(table, max(table.shape[1] - k, 0), axis=1)[:, max(table.shape[1] - k, 0)]
    row, col = np.nonzero((table >= least[:, None]) & (table != NONE))
    order = np.lexsort((col, -table[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    return row[place < k], col[place < k]


class Side:
    """Rows of one side of a tile."""

    def __init__(self, rows: pa.Table):
        self.no = rows.column("no").to_numpy()
        self.id = rows.column("id").combine_chunks()
        vectors = rows.column("v").combine_chunks()
        self.v = vectors.flatten().to_numpy().reshape(len(self.no), -1) if len(vectors.flatten()) else np.zeros((len(self.no), 0), np.int64)


def _paired(left: pa.Table, right: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Both sides, the candidates by id; a tile that lacks one side has no rows."""
    if not left.num_rows or not right.num_rows:
        left, right = left.slice(0, 0), right.slice(0, 0)
    return left, right.take(pc.sort_indices(right, [("id", "ascending"), ("no", "ascending")]))


def _labels(a: pa.Table, c: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    both = pa.concat_arrays([x.column("label").combine_chunks() for x in (a, c)]).dictionary_encode().indices.to_numpy()
    return both[: a.num_rows], both[a.num_rows :]


def _table(cols: dict) -> pa.Table:
    return pa.table({k: x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for k, x in cols.items()})


def _positive_tile(k: int, id_type: pa.DataType):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = _paired(left, right)
        a, c = Side(left), Side(right)
        la, lc = _labels(left, right)
        own, other, value = [], [], []
        for label in np.unique(la):
            rows, cols = np.flatnonzero(la == label), np.flatnonzero(lc == label)
            for strip in range(0, len(rows), STRIP):
                part = rows[strip : strip + STRIP]
                s = scores(a.v[part], c.v[cols])
                s[a.no[part][:, None] == c.no[cols]] = NONE
                i, j = best(s, k)
                own.append(part[i])
                other.append(cols[j])
                value.append(s[i, j])
        i, j, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (own, other, value))
        return _table({"no": a.no[i], "other": c.no[j], "other_id": c.id.take(pa.array(j)).cast(id_type), "score": s})

    return run


def _negative_tile(k: int, low: int, high: int, id_type: pa.DataType):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = _paired(left, right)
        a, c = Side(left), Side(right)
        la, lc = _labels(left, right)
        bounds = left.column("positives").to_pylist()
        out = [[] for _ in range(4)]
        for strip in range(0, len(la), STRIP):
            part = np.arange(strip, min(strip + STRIP, len(la)))
            s = scores(a.v[part], c.v)
            s[la[part][:, None] == lc] = NONE
            for place in range(max((len(bounds[r]) for r in part), default=0)):
                have = np.array([r for r in part if len(bounds[r]) > place], np.int64)
                p = [bounds[r][place]["score"] for r in have]
                least = np.array([-(-low * x // 100) for x in p], np.int64)[:, None]
                most = np.array([high * x // 100 for x in p], np.int64)[:, None]
                window = s[have - strip]
                window[(window < least) | (window > most)] = NONE
                i, j = best(window, k)
                for x, got in zip(out, (have[i], np.full(len(i), place), j, window[i, j]), strict=True):
                    x.append(got)
        i, place, j, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        return _table({"no": a.no[i], "place": place, "other": c.no[j], "other_id": c.id.take(pa.array(j)).cast(id_type), "score": s})

    return run


def _merged(heaps: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` of the united heaps of each key, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id", "other")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    spark: SparkSession,
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(scale * x); a score is the inner product of two
    rows. For each row of ``is_anchor`` and each of its ``positives`` best other
    rows of the same label: the ``negatives`` best rows of another label whose
    score is between the two percentages of the positive's. Higher scores come
    first, ties by smaller id. Rows without an id, a label or a vector, or with a
    null or non-finite component, take no part; a repeated row is another row, also
    as a positive; rows of different lengths aren't compared; zero and empty
    vectors score 0. An empty table, or none that fits, gives an empty result.
    Scores are exact up to 2^56 in size and taken as that beyond. Extra columns
    aren't read.
    """
    ship(spark)
    vec = F.col(vector_col)
    whole = F.forall(vec, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    used = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vec.isNotNull() & whole)
    used = used.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"), F.size(vec).alias("d"),
    )
    path = write_scratch(used.withColumn("no", F.monotonically_increasing_id()), "vectors")
    used = spark.read.parquet(path)
    n, m = used.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    across, down = max(-(-n // CANDIDATES), 1), max(-(-m // ANCHORS), 1)

    def dealt(df: DataFrame, mine_: str, blocks: int, other: str, copies: int) -> DataFrame:
        block = F.pmod(F.xxhash64("no"), F.lit(blocks)).cast("int")
        return df.withColumn(mine_, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).groupBy("d", "a", "c")

    id_type = used.schema["id"].dataType
    arrow_id = used.select("id").limit(0).toArrow().schema.field("id").type
    anchors = used.where("anchor").select("d", "no", "id", "label", "v")
    candidates = spark.read.parquet(path).select("d", "no", "id", "label", "v")  # read anew: columns of its own
    right = dealt(candidates, "c", across, "a", down)
    heap = f"no long, other long, other_id {id_type.simpleString()}, score long"
    found = dealt(anchors, "a", down, "c", across).cogroup(right).applyInArrow(_positive_tile(positives, arrow_id), heap)
    found = spark.read.parquet(write_scratch(_merged(found, ["no"], positives), "positives"))

    listed = found.groupBy("no").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("positives"))
    anchors = anchors.join(listed, "no").select("d", "no", "id", "label", "v", "positives")
    heap = f"no long, place long, other long, other_id {id_type.simpleString()}, score long"
    got = dealt(anchors, "a", down, "c", across).cogroup(right).applyInArrow(_negative_tile(negatives, *window, arrow_id), heap)
    got = _merged(got, ["no", "place"], negatives).select(
        "no", (F.col("place") + 1).cast("int").alias("of"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    of = found.select("no", F.col("rank").alias("of"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = used.where("anchor").select("no", F.col("id").alias("anchor_id"))
    return got.join(of, ["no", "of"]).join(named, "no").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
