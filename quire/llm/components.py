"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import write_scratch


def _written(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.read.parquet(write_scratch(df, "stars"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (u long, v long): root is the
    smallest node reachable. Self links keep a lone node.

    Each round hooks every node's larger neighbours to its smallest one, then
    its smaller neighbours likewise; both are a combined minimum per node and a
    join (with an aggregate below it, so a node with many links is one task).
    Each round's edges are written to the shared folder. It ends when a round changes nothing: after a
    logarithmic number of rounds, and then the edges are the stars themselves.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = _written(spark, e)
    nodes = e
    stamp = None
    while True:
        both = e.where("u != v").select("u", "v").unionByName(e.where("u != v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = _written(spark, large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        e = _written(spark, small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(r) == stamp:
            break
        stamp = tuple(r)
    everyone = nodes.select(F.col("u").alias("node")).unionByName(nodes.select(F.col("v").alias("node"))).distinct()
    return everyone.join(e.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
