"""Connectors: Kafka (S5-S7, K5, K7, K8), JDBC (S11), catalog tables (K1-K4,
S9, S11) and the memory / foreachBatch sinks (K6, T10).

The Kafka data source ships as a separate package (``spark-sql-kafka``); it is
not in this environment, so the Kafka functions here are tested for their
options and record shapes only, and run end to end wherever the package is on
the classpath. Every Kafka function has a file-based twin used by the tests
and the registered queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# ------------------------------------------------------------------- Kafka


def kafka_options(bootstrap: str, topic: str | None = None, starting: str | None = None, **extra: str) -> dict:
    """Options of the Kafka source: brokers, subscription and (T8) the start
    offset policy (``earliest`` in the reference)."""
    opts = {"kafka.bootstrap.servers": bootstrap}
    if topic is not None:
        opts["subscribe"] = topic
    if starting is not None:
        opts["startingOffsets"] = starting
    opts.update(extra)
    return opts


def read_kafka_stream(spark: SparkSession, bootstrap: str, topic: str, starting: str = "earliest", **extra: str) -> DataFrame:
    """Unbounded (key, value, topic, partition, offset, timestamp) rows."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, starting, **extra)).load()


def read_kafka_batch(spark: SparkSession, bootstrap: str, topic: str, starting: str = "earliest", **extra: str) -> DataFrame:
    """The topic's current content as a bounded DataFrame."""
    return spark.read.format("kafka").options(**kafka_options(bootstrap, topic, starting, **extra)).load()


def as_text_pairs(kafka_rows: DataFrame) -> DataFrame:
    """Binary key and value to text; partition and offset are kept as
    the arrival-order tie-break."""
    cols = [F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")]
    for c in ("partition", "offset"):
        if c in kafka_rows.columns:
            cols.append(F.col(c))
    return kafka_rows.select(*cols)


def kafka_stream_writer(records: DataFrame, bootstrap: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """K5/K7: a streaming Kafka sink; ``records`` must hold text/binary
    ``key`` and ``value`` (D8). One checkpoint folder per query (D10)."""
    return (
        records.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def write_kafka_batch(records: DataFrame, bootstrap: str, topic: str) -> None:
    """K8: publish a table of (key, value) records - the distributed form of
    the reference's single-process producer."""
    records.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option(
        "topic", topic
    ).save()


# -------------------------------------------------------------------- JDBC


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict:
    """JDBC read options; a numeric ``partition_column`` with bounds
    splits the read into ``num_partitions`` parallel range queries instead of
    one connection reading the whole table."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower, upper and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(num_partitions),
        )
    opts.update(extra)
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()


# ------------------------------------------------------------------ tables


def _hive_enabled(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive"


def create_table(
    spark: SparkSession,
    database: str,
    table: str,
    columns_ddl: str,
    location: str | None = None,
    using: str | None = None,
) -> str:
    """K2: ``CREATE DATABASE`` and ``CREATE TABLE ... IF NOT EXISTS``. Uses
    Hive tables when the session has Hive support, else Parquet tables in the
    session catalog. Returns the qualified name."""
    fmt = using or ("hive" if _hive_enabled(spark) else "parquet")
    db_loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{db_loc}")
    name = f"{database}.{table}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING {fmt}")
    return name


def append_table(df: DataFrame, name: str) -> None:
    """K1/K3/K4: append rows by column position into an existing table - a
    DataFrame write, never data spliced into SQL text (D6)."""
    df.write.mode("append").insertInto(name)
