from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.session import scratch_path
from quire.sources import connectors as C
from quire.sources.files import csv_scan, from_rows, range_numbers, read_format, write_format


def test_range_even_is_500(spark):
    # The reference suite's one assertion.
    assert range_numbers(spark, 1000).where("number % 2 = 0").count() == 500


def test_from_rows(spark):
    df = from_rows(spark, ["ann,north", "bo,south"])
    assert df.columns == ["raw"] and df.count() == 2


def test_csv_with_inferred_types(spark, tmp_path):
    rows = [("Ata", "Bel", 3), ("Ata", "Cor, Old", 40), ("Bel", "Ata", 500), ("Cor, Old", "Ata", 6)]
    (tmp_path / "trips.csv").write_text("to,from,count\n" + "".join(f'"{a}","{b}",{n}\n' for a, b, n in rows))
    df = csv_scan(spark, str(tmp_path / "trips.csv"))
    assert dict(df.dtypes) == {"to": "string", "from": "string", "count": "int"}
    top = df.groupBy("to").agg(F.sum("count").alias("n")).orderBy(F.desc("n")).limit(2).collect()
    assert [tuple(r) for r in top] == [("Bel", 500), ("Ata", 43)]
    assert df.filter(F.col("from").contains(",")).count() == 1
    assert [r.to for r in df.orderBy("count").take(2)] == ["Ata", "Cor, Old"]


def test_kafka_functions_ask_for_the_source(spark, tmp_path):
    """The Kafka package is absent, so the calls end at Spark's source lookup;
    they have passed their own options and record checks before that."""
    records = spark.createDataFrame([("k", "v")], "key string, value string")
    missing = "kafka|KAFKA"
    with pytest.raises(Exception, match=missing):
        C.read_kafka_batch(spark, "b:9092", "t")
    with pytest.raises(Exception, match=missing):
        C.read_kafka_stream(spark, "b:9092", "t")
    with pytest.raises(Exception, match=missing):
        C.write_kafka_batch(records, "b:9092", "t")
    stream = spark.readStream.schema("key string, value string").json(str(tmp_path))
    with pytest.raises(Exception, match=missing):
        C.kafka_stream_writer(stream, "b:9092", "t", str(tmp_path / "c")).start()


def test_formats_roundtrip(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b,c")], "id int, name string")
    for fmt in ("parquet", "orc", "json", "csv"):
        path = scratch_path(spark, f"t-{fmt}")
        opts = {"header": "true"} if fmt == "csv" else {}
        write_format(df, fmt, path, **opts)
        back = read_format(spark, fmt, path, schema="id int, name string", **opts)
        assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b,c")]


def test_kafka_and_jdbc_options():
    assert C.kafka_options("b:9092", "t", "earliest") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
    }
    o = C.jdbc_options("jdbc:x", "tbl", partition_column="id", lower=0, upper=100, num_partitions=4)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4"
    try:
        C.jdbc_options("jdbc:x", "tbl", partition_column="id")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_kafka_rows_to_text_pairs(spark):
    # Same schema the Kafka source produces (binary key/value).
    rows = spark.createDataFrame(
        [(bytearray(b"k1"), bytearray(b"v1"), "t", 0, 5)], "key binary, value binary, topic string, partition int, offset long"
    )
    out = C.as_text_pairs(rows)
    assert out.columns == ["key", "value", "partition", "offset"]
    assert tuple(out.first())[:2] == ("k1", "v1")


def test_create_and_append_table(spark):
    name = C.create_table(spark, "quire_t", "kv_tbl", "k STRING, tags ARRAY<STRING>", location=scratch_path(spark, "wh"))
    C.append_table(spark.createDataFrame([("a", ["x"])], "k string, tags array<string>"), name)
    C.append_table(spark.createDataFrame([("b", [])], "k string, tags array<string>"), name)
    assert sorted(r.k for r in spark.table(name).collect()) == ["a", "b"]
