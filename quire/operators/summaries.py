"""Mergeable summaries kept in a table and rolled up over any range (A3, A4, A7,
A14): exact distinct ids as bitmaps, distinct values as HyperLogLog sketches and
quantiles as KLL sketches.

Each summary is built once per group of a fine key (a day, say) with map-side
partial aggregation; coarser groups are unions of stored rows, so a year is never
counted from its rows again and several distinct counts need no Expand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_K = 14  # 2^14 registers: a standard error of about 0.8%
KLL_K = 200  # a rank error of about 1.7% with 99% confidence


def daily_bitmaps(df: DataFrame, keys: dict[str, Column], id_col: str) -> DataFrame:
    """(keys, bucket, bits): which whole-number ids occur, 32,768 ids a bucket of
    4 KB. For ids that are dense in the buckets a group touches; else prefer
    ``distinct_sketches``. Null ids are left out."""
    i = F.col(id_col).cast("long")
    rows = df.where(F.col(id_col).isNotNull()).select(
        *[c.alias(n) for n, c in keys.items()], F.bitmap_bucket_number(i).alias("bucket"), F.bitmap_bit_position(i).alias("at")
    )
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def rollup_bitmaps(bitmaps: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(keys, bucket, bits) of coarser keys: the united bitmaps."""
    return bitmaps.groupBy(*[c.alias(n) for n, c in keys.items()], "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The exact number of distinct ids per key. Distinct buckets hold distinct
    ids, so their counts add up."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("ids"))


def distinct_sketches(df: DataFrame, keys: dict[str, Column], col: str, lg_k: int = HLL_K) -> DataFrame:
    """(keys, sketch): a HyperLogLog sketch of the values of a column per key."""
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.hll_sketch_agg(col, lg_k).alias("sketch"))


def estimate_distinct(sketches: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(keys, estimate): distinct values of the united sketches per key."""
    united = F.hll_union_agg("sketch")
    return sketches.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.hll_sketch_estimate(united).alias("estimate"))


def quantile_sketches(df: DataFrame, keys: dict[str, Column], col: str, k: int = KLL_K) -> DataFrame:
    """(keys, sketch): a KLL sketch of a column's values per key; nulls left out."""
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], probs: dict[str, float], k: int = KLL_K) -> DataFrame:
    """(keys, rows, one cut point per probability) of the merged sketches of each
    key; nothing passes through the driver."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("s"))
    cuts = [F.kll_sketch_get_quantile_double("s", F.lit(p)).alias(n) for n, p in probs.items()]
    return merged.select(*keys, F.kll_sketch_get_n_double("s").alias("rows"), *cuts)
