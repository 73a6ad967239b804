"""Exact global ranks, top fractions and exact quantiles without a single-task
step.

``Window.orderBy(...)`` with no partition, ``orderBy().limit(k)`` with a ``k``
that grows with the data, ``percentile_disc`` and ``approxQuantile(..., 0.0)``
all funnel every row through one task or the driver. Here the rows are
range-partitioned on the sort key (sampled bounds split a hot key across many
partitions when the sort key has a tie-break), sorted inside each partition and
written to the shared checkpoint folder, which fixes the partition of every row
even if executors are lost and tasks rerun. The row's position inside its
partition comes from ``monotonically_increasing_id`` (partition id in the upper
31 bits, position in the lower 33), and the starting offset of every partition
from a per-partition count: one row per partition, a table whose size is bounded
by the partition count, never by the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import checkpoint_dir

_POS_BITS = 33


def _as_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_row_number(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str = "rn",
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with a 1-based ``name`` column equal to ``row_number() over (order
    by <order>)``, computed in parallel. Give a unique tie-break in ``order`` for
    a deterministic numbering."""
    checkpoint_dir(df.sparkSession)
    cols = _as_cols(order)
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = ranged.sortWithinPartitions(*cols).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = ranged.withColumn("_q_mid", mid).select(
        "*",
        F.shiftright(F.col("_q_mid"), _POS_BITS).alias("_q_pid"),
        (F.col("_q_mid").bitwiseAND((1 << _POS_BITS) - 1)).alias("_q_pos"),
    )
    # One row per partition; the running total over them is the offset. This
    # window runs on at most `num partitions` rows.
    per_part = tagged.groupBy("_q_pid").agg(F.count(F.lit(1)).alias("_q_n"))
    offsets = per_part.select(
        "_q_pid",
        (F.sum("_q_n").over(Window.orderBy("_q_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_q_off"),
    ).fillna(0, subset=["_q_off"])
    # Bounded by the partition count of `ranged`, so the broadcast is safe.
    out = tagged.join(F.broadcast(offsets), "_q_pid")
    return out.withColumn(name, F.col("_q_off") + F.col("_q_pos") + F.lit(1)).drop(
        "_q_mid", "_q_pid", "_q_pos", "_q_off"
    )


def top_fraction(
    df: DataFrame, order: Sequence[Column | str], fraction: float, k: int | None = None
) -> tuple[DataFrame, int]:
    """The first ``k = int(fraction * count)`` rows in ``order`` (or an
    explicit ``k``), as a distributed filter rather than a single-task
    ``limit``. Returns (rows, k)."""
    if k is None:
        k = int(fraction * df.count())
    ranked = global_row_number(df, order, name="_q_rank")
    return ranked.filter(F.col("_q_rank") <= k).drop("_q_rank"), k


def quantile_ranks(n: int, probs: Sequence[float]) -> list[int]:
    """1-based ranks of the discrete quantiles: the smallest value whose
    cumulative share reaches ``p`` (``percentile_disc``), i.e. ``ceil(p*n)``."""
    return [min(n, max(1, math.ceil(p * n))) for p in probs]


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact discrete quantiles of each column (nulls ignored), all columns in
    one distributed sort: the columns are stacked as (measure, value) rows and
    ranked once; a measure's ranks start after the rows of the measures before
    it. Only the picked values (``len(cols) * len(probs)``) reach the driver."""
    stacked = (
        df.select(
            F.explode(
                F.array(*[F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
            ).alias("s")
        )
        .select("s.m", "s.v")
        .filter(F.col("v").isNotNull())
    )
    counts = {r["m"]: r["n"] for r in stacked.groupBy("m").agg(F.count(F.lit(1)).alias("n")).collect()}
    targets: dict[int, list[int]] = {}
    base = 0
    for i in range(len(cols)):
        n = counts.get(i, 0)
        targets[i] = [base + r for r in quantile_ranks(n, probs)] if n else []
        base += n
    wanted = sorted({r for rs in targets.values() for r in rs})
    picked: dict[int, float] = {}
    if wanted:
        # Equal values are interchangeable for the picked quantiles, so a
        # random tie-break is safe; it lets the range bounds split a value
        # repeated in a large share of the rows over several partitions.
        spread_ties = stacked.withColumn("_q_t", F.rand(17))
        ranked = global_row_number(spread_ties, ["m", "v", "_q_t"], name="_q_r")
        picked = {r["_q_r"]: r["v"] for r in ranked.filter(F.col("_q_r").isin(wanted)).collect()}
    return {
        c: ([float(picked[r]) for r in targets[i]] if targets[i] else [float("nan")] * len(probs))
        for i, c in enumerate(cols)
    }


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], rel_error: float) -> dict[str, list[float]]:
    """Quartile-style cut points. ``rel_error > 0`` uses Spark's mergeable
    Greenwald-Khanna sketch (``approxQuantile``, bounded memory); ``0.0`` uses the
    exact distributed ranks above instead of an exact sketch, which would carry
    every value to the driver."""
    if rel_error > 0:
        res = df.approxQuantile(list(cols), list(probs), rel_error)
        return {c: [float(v) for v in r] for c, r in zip(cols, res)}
    return exact_quantiles(df, cols, probs)
