"""File scans and writes (S1, S2, S10) plus the range and in-memory sources
(S3, S4).

CSV inference runs an extra pass over the input; it is offered because the
reference loads its CSV files that way, but every other reader takes a declared
schema, and ``csv_scan`` accepts one too (recommended at scale).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("parquet", "orc", "json", "csv", "text")


def csv_scan(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    repartition: int | None = None,
) -> DataFrame:
    """CSV with a header; a glob such as ``daily/*.csv`` reads a folder
    of daily files. Types are inferred unless ``schema`` is given. P16: an
    explicit ``repartition`` count is a parameter, off by default (AQE sizes
    the shuffles that follow)."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    df = reader.csv(path)
    return df.repartition(repartition) if repartition else df


def read_format(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """JSON, Parquet, ORC, CSV or text through one entry point."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None and fmt != "text":
        reader = reader.schema(schema)
    return reader.load(path)


def write_format(df: DataFrame, fmt: str, path: str, mode: str = "overwrite", **options: str) -> str:
    """Write a DataFrame in one of ``FORMATS``; text needs one string column."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    df.write.format(fmt).mode(mode).options(**options).save(path)
    return path


def range_numbers(spark: SparkSession, n: int, name: str = "number") -> DataFrame:
    """S3: ``range(n)`` renamed, generated in parallel on the executors."""
    return spark.range(n).toDF(name)


def from_rows(spark: SparkSession, rows: Iterable[str], name: str = "raw") -> DataFrame:
    """A driver-side collection as a one-column DataFrame. Only for small,
    literal inputs (tests, lookup seeds); data never takes this path."""
    return spark.createDataFrame([(r,) for r in rows], f"{name} string")
