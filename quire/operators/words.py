"""Word count (B9, A18): lines to (word, count).

The explode stays in the scan's stage and the count is a hash aggregate with a
map-side partial count, so a very frequent word is pre-summed in every task
before the shuffle and never piles up as raw rows in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import WORD_SEPARATOR, java_trim


def words(df: DataFrame, text_col: str = "text", pattern: str = WORD_SEPARATOR) -> DataFrame:
    """One row per token, in the reference's flatMapValues form (X13: lower,
    Java-style split). The regex split is projected once into a column and
    the trailing-empty rule applied to that column, so each text is split
    exactly once."""
    lowered = df.select(F.lower(F.col(text_col)).alias("_s"))
    parts = lowered.select("_s", F.split(F.col("_s"), pattern, -1).alias("_p"))
    return parts.select(F.explode(java_trim(F.col("_p"), F.col("_s"), pattern)).alias("word"))


def word_count(df: DataFrame, text_col: str = "text", pattern: str = WORD_SEPARATOR, deal: int | None = None) -> DataFrame:
    """Running count per word (batch: the final table; stream: the changelog
    of the same aggregate). ``deal`` (off by default) deals the texts round-robin
    over that many tasks first: it costs a shuffle of the text column and pays
    where the input comes in fewer row groups than there are cores."""
    if deal:
        df = df.select(text_col).repartition(deal)
    return words(df, text_col, pattern).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_count_updates(counts: DataFrame) -> DataFrame:
    """K7 shape: the aggregate's updates as (key, value) text pairs, the count
    rendered as text (X22)."""
    return counts.select(F.col("word").alias("key"), F.col("count").cast("string").alias("value"))
