"""A replica kept in hash buckets, of which a batch rewrites those it touches.

Rows of a key are in the bucket of its hash. A batch reads the buckets of its own
keys, merges the changes into them and writes them below ``data/v=<batch>``; the
others stay where they are. A manifest per batch names the version of every
bucket and is written last, so a reader sees a batch whole or not at all, and a
replayed batch gives the same version again. Buckets that neither of the two
newest manifests names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.cdc import cdc_apply_with_deletes
from quire.session import complete_folders, remove_path

BUCKETS = 64
MANIFEST = "bucket int, v long"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, out_dir: str, version: int) -> dict[int, int]:
    """Bucket -> version of its folder; one row per bucket."""
    rows = spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest/v={version}").collect()
    return {r.bucket: r.v for r in rows}


def _paths(out_dir: str, named: dict[int, int]) -> list[str]:
    return [f"{out_dir}/data/v={v}/bucket={b}" for b, v in sorted(named.items())]


def replica_batch(out_dir: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """B12 on a stream, for ``foreachBatch``: every micro-batch of decoded changes
    is merged into the replica; changed keys take their last change, deleted keys
    go and leave nothing behind. A bucket is one file of the replica and one task:
    choose ``buckets``, which stay the same for a replica's life, so that a bucket
    is some 100 MB. Changes of a key must arrive in order, as a topic's partition
    keeps them."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = [b for b in complete_folders(spark, f"{out_dir}/manifest", "v=") if b < batch_id]
        old = manifest(spark, out_dir, versions[-1]) if versions else {}
        rows = batch.select("after.*").schema
        changes = cdc_apply_with_deletes(batch).withColumn("bucket", bucket_of(F.col("id"), buckets)).persist()
        try:
            touched = [r.bucket for r in changes.select("bucket").distinct().collect()]  # at most ``buckets``
            paths = _paths(out_dir, {b: old[b] for b in touched if b in old})
            current = spark.read.schema(rows).parquet(*paths) if paths else spark.createDataFrame([], rows)
            untouched = current.join(changes.select("id"), "id", "left_anti").select(*rows.names)
            merged = untouched.unionByName(changes.where(F.col("op") != "d").select("after.*"))
            target = f"{out_dir}/data/v={batch_id}"
            placed = merged.withColumn("bucket", bucket_of(F.col("id"), buckets)).repartition("bucket")
            placed.write.mode("overwrite").partitionBy("bucket").parquet(target)
        finally:
            changes.unpersist()
        named = {b: v for b, v in old.items() if b not in touched}
        named |= {b: batch_id for b in complete_folders(spark, target, "bucket=", mark=None)}
        spark.createDataFrame(sorted(named.items()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/manifest/v={batch_id}")
        kept = set(old.items()) | set(named.items())
        for version in versions[:-1]:
            for b, v in manifest(spark, out_dir, version).items():
                if (b, v) not in kept:
                    remove_path(spark, f"{out_dir}/data/v={v}/bucket={b}")
            remove_path(spark, f"{out_dir}/manifest/v={version}")

    return run


def replica(spark: SparkSession, out_dir: str, schema) -> DataFrame:
    """The replica as of its newest manifest."""
    version = complete_folders(spark, f"{out_dir}/manifest", "v=")[-1]
    paths = _paths(out_dir, manifest(spark, out_dir, version))
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
