"""Parquet tables of a data folder (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table. Column pruning and filter pushdown reach the Parquet
    reader because callers only select/filter on the returned DataFrame."""
    return spark.read.parquet(table_path(sf_dir, name))
