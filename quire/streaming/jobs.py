"""Streaming forms of the operators.

Every stateful job here keys its state by event-time window (bounded by the
window length) or by word / row key, and the sliding jobs carry a watermark so
closed windows leave the state store (D4). Event times of the driver tables
are TIMESTAMP_NTZ; watermarks need TIMESTAMP, so they are cast first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quire.operators import ticks as TK
from quire.operators.words import word_count
from quire.session import complete_folders, remove_path
from quire.sources.connectors import as_text_pairs, read_kafka_stream, write_kafka_batch


def source(
    spark: SparkSession,
    kind: str,
    *,
    path: str | None = None,
    schema: StructType | str | None = None,
    bootstrap: str | None = None,
    topic: str | None = None,
    starting: str = "earliest",
    max_files_per_trigger: int | None = None,
    path_glob: str | None = None,
    repartition: int | None = None,
) -> DataFrame:
    """One entry point for stream sources: ``kafka`` (text key/value
    pairs) or a file format (``parquet``, ``json``, ``csv``, ``text``) read
    from the folder ``path`` (optionally only files matching ``path_glob``)
    with a declared schema. ``repartition`` (off by default) deals each
    micro-batch round-robin over that many tasks, at the cost of a shuffle: only
    for streams of few large, unsplittable files."""
    if kind == "kafka":
        return as_text_pairs(read_kafka_stream(spark, bootstrap, topic, starting))
    reader = spark.readStream.format(kind)
    if schema is not None and kind != "text":
        reader = reader.schema(schema)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    return df.repartition(repartition) if repartition else df


def sliding_window_stats(values: DataFrame, window: str, slide: str | None, lateness: str) -> DataFrame:
    """T2/T3 + T11: per key and window, count and exact total, emitted in
    append mode once the watermark passes the window end."""
    return TK.window_stats(values.withWatermark("event_time", lateness), window, slide, prebucket=False)


def closed_buckets(values: DataFrame, slide: str, lateness: str) -> DataFrame:
    """T3 + T11: ticks wait in state in the tumbling bucket of the slide's length
    that holds them and come out as rows when the watermark closes it. A tick is a
    state row of its own (equal ones are counted), so state is only appended to and
    a busy instrument is many rows, never one growing list. Windows are built of
    whole buckets, so a window behind the watermark has all its ticks in the output."""
    held = values.withWatermark("event_time", lateness).withColumn("at", F.unix_micros("event_time"))
    return _as_ticks(held.groupBy("key", F.window("event_time", slide), "at", "seq", "x").agg(F.count(F.lit(1)).alias("n")))


def _as_ticks(held: DataFrame) -> DataFrame:
    again = F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int"))).alias("_one")
    return held.select("key", F.col("window.end").alias("bucket_end"), F.timestamp_micros("at").alias("event_time"), "seq", "x", again).drop("_one")


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """T11 + T7: the windows of ``sliding_window_stats`` that the last watermark
    has not closed, as they stand in the state of the query's checkpoint, read
    with Spark's state data source. The sink and these are all windows of what a
    finished run has read, none twice: a closed window has left the state."""
    w, v = F.col("key.window"), F.col("value")
    return spark.read.format("statestore").load(checkpoint).select(
        F.col("key.key").alias("key"), w["start"].alias("window_start"), w["end"].alias("window_end"),
        v["count"].alias("n"), v["sum"].cast("double").alias("total"),
    )


def open_ticks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """T11 + T7: the ticks of ``closed_buckets`` that still wait in the state of
    the query's checkpoint, in the rows of its sink."""
    return _as_ticks(spark.read.format("statestore").load(checkpoint).select("key.*", F.col("value")["count"].alias("n")))


def watermark_of(q: StreamingQuery) -> str | None:
    """The last watermark a finished query reached, as its progress tells it."""
    marks = [p["eventTime"]["watermark"] for p in q.recentProgress if "watermark" in (p["eventTime"] or {})]
    return max(marks, default=None)


def closed_macd(buckets: DataFrame, watermark: str | None, window: str, slide: str, span: int = TK.SHORT_SPAN) -> DataFrame:
    """B7 + T2: MACD of the windows that end at the watermark or before, over
    the closed buckets' ticks (the sink of ``closed_buckets``); the batch
    operator, so each tick is stored and shuffled once and not per window."""
    if watermark is None:
        raise ValueError("no watermark has been reached, so no window is closed")
    rows = TK.macd_windows(buckets, window, slide, span)
    return rows.filter(F.col("window_end") <= F.lit(watermark).cast("timestamp"))


def word_count_stream(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """The running word count; write with ``update`` (changelog, K7)
    or ``complete`` output mode."""
    return word_count(lines, text_col)


def changelog_batch(out_dir: str, keys: list[str] | None = None, compact_every: int = 16) -> Callable[[DataFrame, int], None]:
    """K7 shape on files: each micro-batch's updated rows (``update`` output
    mode) go to ``log/batch_id=<id>``; overwriting that folder makes a replayed
    batch idempotent. With ``keys``, every ``compact_every`` batches the log so
    far is reduced to the latest row per key in ``base/upto=<id>`` and the
    folders it covers are deleted, so reads do not grow with history."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{out_dir}/log/batch_id={batch_id}")
        if keys and batch_id % compact_every == compact_every - 1:
            done = [b for b in complete_folders(spark, f"{out_dir}/log", "batch_id=") if b <= batch_id]
            bases = complete_folders(spark, f"{out_dir}/base", "upto=")
            compact_changelog(spark, out_dir, keys).write.mode("overwrite").parquet(f"{out_dir}/base/upto={batch_id}")
            for b in done:
                remove_path(spark, f"{out_dir}/log/batch_id={b}")
            for b in bases:
                if b < batch_id:
                    remove_path(spark, f"{out_dir}/base/upto={b}")

    return run


def compact_changelog(spark: SparkSession, out_dir: str, keys: list[str]) -> DataFrame:
    """The current table of an update-mode changelog: per key, the row of the
    latest batch (``max_by``, a partial aggregate) of the newest base and the
    log behind it."""
    bases = complete_folders(spark, f"{out_dir}/base", "upto=")
    base = bases[-1] if bases else -1
    parts = [(base, f"{out_dir}/base/upto={base}")] if bases else []
    parts += [(b, f"{out_dir}/log/batch_id={b}") for b in complete_folders(spark, f"{out_dir}/log", "batch_id=") if b > base]
    frames = [spark.read.parquet(path).withColumn("batch_id", F.lit(b)) for b, path in parts]
    log = frames[0]
    for f in frames[1:]:
        log = log.unionByName(f)
    values = [c for c in log.columns if c not in keys and c != "batch_id"]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("_row"))
    return latest.select(*keys, "_row.*")


FANOUT_TABLES = {
    "parameters": "key STRING, value STRING, batch_id BIGINT",
    "indexes": "key STRING, type STRING, value DOUBLE, time TIMESTAMP, batch_id BIGINT",
}


def fanout_tables(spark: SparkSession, database: str, suffix: str = "", location: str | None = None) -> dict[str, str]:
    """K3 + K4: the two catalog tables of the fan-out, partitioned by batch."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    names = {}
    for name, columns in FANOUT_TABLES.items():
        names[name] = f"{database}.{name}{suffix}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {names[name]} ({columns}) USING parquet PARTITIONED BY (batch_id)")
    return names


def fanout_batch(tables: dict[str, str], topic_dir: str, kafka: tuple[str, str] | None = None, seq_col: str = "offset") -> Callable[[DataFrame, int], None]:
    """T10 + K3 + K4 + K5: a ``foreachBatch`` function writing one micro-batch
    of tick records to three places: the raw (key, value) table, the indicator
    table (key, type, value, time TIMESTAMP) and the indicator topic (JSON
    values; a file folder unless ``kafka`` = (bootstrap, topic) is given).
    ``seq_col`` is the arrival order: ``offset`` for rows of a Kafka source.

    The batch is parsed once and persisted because it feeds three writes. The
    tables' and folder's part of a batch is overwritten, so a replayed batch
    replaces its own rows there. A topic only takes appends: a replay sends its
    records again (at least once)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = TK.parse_ticks(batch, "value", seq_col=seq_col).persist()
        try:
            raw = parsed.select("key", F.col("record").alias("value"))
            rows = TK.indicator_rows(parsed, full_time=True)
            for name, df in (("parameters", raw), ("indexes", rows)):
                target = f"{tables[name]} PARTITION (batch_id = {int(batch_id)})"
                batch.sparkSession.sql(f"INSERT OVERWRITE TABLE {target} SELECT * FROM {{df}}", df=df)
            records = TK.to_kafka_records(rows)
            if kafka:
                write_kafka_batch(records, *kafka)
            else:
                records.write.mode("overwrite").json(f"{topic_dir}/batch_id={batch_id}")
        finally:
            parsed.unpersist()

    return run
