"""Registered streaming queries: each runs a Structured Streaming job over a
driver table read as a file stream, to completion (``availableNow``), and
returns the sink's content as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import ticks as TK
from quire.operators.cdc import cdc_decode
from quire.operators.stats_json import flatten_statistics
from quire.operators.words import word_count_updates
from quire.plans import fixtures as FX
from quire.session import is_folder, scratch_path
from quire.sources.connectors import as_text_pairs
from quire.sources.tables import load, table_path
from quire.streaming import jobs as J
from quire.streaming.bars import on_rocksdb, open_bars, timed_bars
from quire.streaming.listener import ProgressTable
from quire.streaming.replica import replica, replica_batch
from quire.streaming.runner import checkpoint_for, run_available_now, unique_name

LATENESS = "1 hour"
MACD_WINDOW = ("780 minutes", "30 minutes")


def _file_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table as a file stream. The source reads folders: that of a table in
    several files, or, for a table in one file, the data folder with all other
    files left out."""
    schema = load(spark, sf_dir, table).schema  # footer read only
    path = table_path(sf_dir, table)
    if is_folder(spark, path):
        return J.source(spark, "parquet", path=path, schema=schema)
    return J.source(spark, "parquet", path=sf_dir, schema=schema, path_glob=f"{table}.parquet")


def run_to_memory(df: DataFrame, name: str, mode: str) -> str:
    """K6: run ``df`` into a memory sink and return its table name. The
    memory sink keeps the whole output in driver memory - a debugging sink for
    small outputs; the registered queries below use file sinks instead."""
    spark = df.sparkSession
    qname = unique_name(name)
    writer = (
        df.writeStream.format("memory")
        .queryName(qname)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint_for(spark, qname))
    )
    run_available_now(writer)
    return qname


def _run_to_files(df: DataFrame, name: str, checkpoint: str | None = None) -> str:
    """Append-mode output to the Parquet file sink (exactly-once through the
    sink's commit log); returns the folder."""
    spark = df.sparkSession
    out = scratch_path(spark, name)
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint or checkpoint_for(spark, name))
    )
    run_available_now(writer)
    return out


def _run_changelog(df: DataFrame, name: str, keys: list[str]) -> str:
    """Update-mode output as a per-batch changelog (K7 on files)."""
    spark = df.sparkSession
    out = scratch_path(spark, name)
    writer = (
        df.writeStream.outputMode("update")
        .foreachBatch(J.changelog_batch(out, keys))
        .option("checkpointLocation", checkpoint_for(spark, name))
    )
    run_available_now(writer)
    return out


def stream_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 (file stand-in) + P5: the key/value stream appended to a table,
    then queried by SQL through a view (S8, S9)."""
    ev = _file_stream(spark, sf_dir, "events")
    # binary columns, as a topic's records have them
    kv = as_text_pairs(ev.select(F.col("event_id").cast("string").cast("binary").alias("key"), F.col("event_type").cast("binary").alias("value")))
    view = unique_name("kv")
    spark.read.parquet(_run_to_files(kv, "kv")).createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {view}")


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 + T6 + K7: running word count over the documents stream in update
    mode; the changelog compacted to the current counts."""
    docs = _file_stream(spark, sf_dir, "documents")
    out = _run_changelog(J.word_count_stream(docs, "text"), "word_count", ["word"])
    return J.compact_changelog(spark, out, ["word"])


def stream_word_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 + X22: the same changelog as (word, count text) records."""
    docs = _file_stream(spark, sf_dir, "documents")
    updates = word_count_updates(J.word_count_stream(docs, "text"))
    out = _run_changelog(updates, "word_text", ["key"])
    return J.compact_changelog(spark, out, ["key"])


def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics messages flattened on a stream, by the batch function."""
    src = scratch_path(spark, "messages")
    FX.statistics_messages(spark, sf_dir).write.parquet(src)
    messages = J.source(spark, "parquet", path=src, schema="key string, value string")
    rows = spark.read.parquet(_run_to_files(flatten_statistics(messages), "stats"))
    return rows.withColumn("quotaType", F.to_json("quotaType"))


def _tick_values_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _file_stream(spark, sf_dir, "events")
    parsed = TK.parse_ticks(FX.tick_records_of(ev), "value", seq_col="event_id")
    return TK.tick_values(parsed)


def stream_slide_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T11 + T7: sliding 26-minute windows, watermark lateness 1 hour,
    append mode; the windows still open when the run ends come from its state."""
    stats = J.sliding_window_stats(_tick_values_stream(spark, sf_dir), "26 minutes", "1 minute", LATENESS)
    state = checkpoint_for(spark, "slide")
    return spark.read.parquet(_run_to_files(stats, "slide", state)).unionByName(J.open_windows(spark, state))


def stream_macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 on a stream: MACD per window, of the ticks of closed buckets and of
    those that still wait in state when the run ends."""
    window, slide = MACD_WINDOW
    state = checkpoint_for(spark, "buckets")
    out = _run_to_files(J.closed_buckets(_tick_values_stream(spark, sf_dir), slide, LATENESS), "buckets", state)
    ticks = spark.read.parquet(out).unionByName(J.open_ticks(spark, state))
    return TK.macd_windows(ticks, window, slide)


def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 + T3: open, high, low and close per key and 30 minutes from ticks in a
    list state on RocksDB, released by timers; the open bars from that state."""
    own = on_rocksdb(spark)
    values = _tick_values_stream(own, sf_dir)
    state = checkpoint_for(own, "bars")
    closed = spark.read.parquet(_run_to_files(timed_bars(values, MACD_WINDOW[1], LATENESS), "bars", state))
    return closed.unionByName(open_bars(spark, state, MACD_WINDOW[1]))


def stream_macd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X12 + X21: the closed windows' rows as (key, JSON) records for a topic,
    decoded again."""
    records = TK.to_kafka_records(stream_macd(spark, sf_dir).select("key", "type", "value", "split"))
    row = F.from_json("value", TK.INDICATOR_SCHEMA)
    return records.select("key", row.alias("r")).select("key", "r.type", "r.value", "r.split")


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick stream of Kafka-shaped rows to the raw table, the
    indicator table and the indicator topic via ``foreachBatch``; both tables."""
    ev = _file_stream(spark, sf_dir, "events")
    records = FX.tick_records_of(ev).select(F.lit(None).cast("string").alias("key"), "value", F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
    tables = J.fanout_tables(spark, "quire_db", f"_{unique_name('t')}", scratch_path(spark, "warehouse"))
    writer = records.writeStream.foreachBatch(J.fanout_batch(tables, scratch_path(spark, "topic"))).option(
        "checkpointLocation", checkpoint_for(spark, "fanout")
    )
    run_available_now(writer)
    raw = F.split("value", ",")
    parameters = spark.table(tables["parameters"]).select(
        F.lit("parameters").alias("target"), "key", F.lit(None).cast("string").alias("type"), F.lit(None).cast("double").alias("value"),
        F.to_timestamp(F.concat_ws(" ", F.get(raw, F.lit(31)), F.get(raw, F.lit(32)))).alias("time"), F.get(raw, F.lit(1)).cast("long").alias("seq"),
    )
    indexes = spark.table(tables["indexes"]).select(F.lit("indexes").alias("target"), "key", "type", "value", "time", F.lit(None).cast("long").alias("seq"))
    return indexes.unionByName(parameters)


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 + K10: a windowed run over several files whose batches a listener
    records in a table; rows read, batches that read any, the last watermark."""
    src, path, out = scratch_path(spark, "ticks"), scratch_path(spark, "progress"), scratch_path(spark, "progress-out")
    FX.tick_records(spark, sf_dir).repartition(4).write.json(src)
    ticks = J.source(spark, "json", path=src, schema="event_id long, value string", max_files_per_trigger=1)
    stats = J.sliding_window_stats(TK.tick_values(TK.parse_ticks(ticks, "value", seq_col="event_id")), "26 minutes", None, LATENESS)
    listener = ProgressTable(spark, path)
    spark.streams.addListener(listener)
    try:
        writer = stats.writeStream.format("parquet").outputMode("append").option("path", out)
        listener.await_end(run_available_now(writer.option("checkpointLocation", checkpoint_for(spark, "progress"))))
    finally:
        listener.close()
    mark = F.max(F.to_timestamp("watermark")).cast("timestamp_ntz").alias("watermark")
    return listener.table().agg(F.sum("input_rows").alias("rows"), F.count_if(F.col("input_rows") > 0).alias("batches"), mark)


def stream_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B12 on a stream: change events (from the orders stream) merged batch by
    batch into a bucketed replica from which deleted keys are gone."""
    changes = cdc_decode(FX.change_events_of(_file_stream(spark, sf_dir, "orders")))
    out = scratch_path(spark, "replica")
    writer = changes.writeStream.foreachBatch(replica_batch(out)).option("checkpointLocation", checkpoint_for(spark, "replica"))
    run_available_now(writer)
    return replica(spark, out, changes.select("after.*").schema)


STREAM_MEMORY_SQL = "SELECT CAST(event_id AS VARCHAR) AS key, event_type AS value FROM events"

_TICKS_V = """
SELECT event_type AS key, event_id AS seq, value AS x, date_trunc('second', ts) AS t
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
"""

STREAM_SLIDE_SQL = f"""
WITH v AS ({_TICKS_V}),
w AS (SELECT key, x, unnest(generate_series(date_trunc('minute', t) - INTERVAL 25 MINUTE, date_trunc('minute', t),
                                            INTERVAL 1 MINUTE)) AS ws FROM v)
SELECT key, ws AS window_start, ws + INTERVAL 26 MINUTE AS window_end, count(*) AS n,
       CAST(sum(CAST(CAST(x AS VARCHAR) AS DECIMAL(28,10))) AS DOUBLE) AS total
FROM w GROUP BY ALL
"""

STREAM_PROGRESS_SQL = f"""
SELECT (SELECT count(*) FROM events) AS rows, CAST(4 AS BIGINT) AS batches, (SELECT max(t) FROM ({_TICKS_V}) v) - INTERVAL 1 HOUR AS watermark
"""

STREAM_BARS_SQL = f"""
SELECT key, time_bucket(INTERVAL 30 MINUTE, t, TIMESTAMP '1970-01-01') AS bar_start, count(*) AS n, arg_min(x, (t, seq)) AS open,
       max(x) AS high, min(x) AS low, arg_max(x, (t, seq)) AS close
FROM ({_TICKS_V}) v GROUP BY ALL
"""

STREAM_FANOUT_SQL = """
SELECT 'indexes' AS target, event_type AS key, 'AMO' AS type, value * 10 AS value, date_trunc('second', ts) AS time,
       CAST(NULL AS BIGINT) AS seq FROM events WHERE event_id % 97 <> 0
UNION ALL
SELECT 'indexes', event_type, 'OBV', value, date_trunc('second', ts), NULL FROM events
WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
UNION ALL
SELECT 'parameters', event_type, NULL, NULL, date_trunc('second', ts), CAST(event_id AS BIGINT) FROM events WHERE event_id % 97 <> 0
"""
