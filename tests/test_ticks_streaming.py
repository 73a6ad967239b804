from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import ticks as TK
from quire.operators.introspect import plan_text, stream_plan_text
from quire.session import scratch_path
from quire.sources.connectors import as_text_pairs
from quire.streaming import jobs as J
from quire.streaming.runner import checkpoint_for, run_available_now, unique_name

T0 = dt.datetime(2018, 4, 9, 9, 30, 0)


def line(key: str, seq: int, x, t: dt.datetime, n_fields: int = 34) -> str:
    f = [key, str(seq), "0"] + ["0"] * 8 + [str(x), str(float(x) * 10 if isinstance(x, (int, float)) else 0)]
    f += ["0"] * 18 + [t.strftime("%Y-%m-%d"), t.strftime("%H:%M:%S"), "00"]
    return ",".join(f[:n_fields])


def fold(xs):
    k = 2.0 / (len(xs) + 1)
    e = xs[0]
    for x in xs[1:]:
        e = x * k + e * (1 - k)
    return e


def test_parse_and_indicator_rows(spark):
    recs = [
        (1, line("sh600000", 1, 100.0, T0)),
        (2, json.dumps(line("sh600000", 2, 101.0, T0 + dt.timedelta(minutes=1)))),  # JSON-quoted producer
        (3, line("sh600001", 3, 5.0, T0, n_fields=20)),  # short record
        (4, line("sh600001", 4, "n/a", T0)),  # non-numeric field 11
    ]
    df = spark.createDataFrame(recs, "event_id long, value string")
    parsed = TK.parse_ticks(df, "value", seq_col="event_id")
    assert sorted(r.seq for r in parsed.collect()) == [1, 2, 4]
    rows = sorted(map(tuple, TK.indicator_rows(parsed).collect()))
    assert rows == [
        ("sh600000", "AMO", 1000.0, "09:30:00"),
        ("sh600000", "AMO", 1010.0, "09:31:00"),
        ("sh600000", "OBV", 100.0, "09:30:00"),
        ("sh600000", "OBV", 101.0, "09:31:00"),
        ("sh600001", "AMO", 0.0, "09:30:00"),
    ]
    kafka = TK.to_kafka_records(TK.indicator_rows(parsed)).first()
    assert set(json.loads(kafka.value)) == {"key", "type", "value", "split"}


def test_feed_to_ticks(spark):
    body = ";".join(
        [
            'var hq_str_sh600000="' + line("X", 1, 1.0, T0).split(",", 1)[1] + '"',
            'var hq_str_sh600001="' + line("X", 2, 2.0, T0 - dt.timedelta(days=1)).split(",", 1)[1] + '"',
            'var hq_str_sh600002="a,b,c"',
            "",
        ]
    )
    bodies = spark.createDataFrame([(body,)], "body string")
    assert TK.feed_to_ticks(bodies).count() == 2
    day = TK.feed_to_ticks(bodies, day=T0.strftime("%Y-%m-%d"))
    assert [r.record.split(",")[0] for r in day.collect()] == ["sh600000"]


def _dense_ticks(spark, n=1500, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 else rnd.choice(["a", "b"])
        t = T0 + dt.timedelta(seconds=rnd.randint(0, 3 * 3600))
        rows.append((i, line(key, i, round(rnd.uniform(1, 100), 2), t)))
    return spark.createDataFrame(rows, "event_id long, value string")


def test_ema_by_key_matches_fold(spark):
    vals = TK.tick_values(TK.parse_ticks(_dense_ticks(spark), "value", seq_col="event_id"))
    local = sorted(map(tuple, vals.collect()), key=lambda r: (r[0], r[1], r[2]))
    by_key: dict[str, list[float]] = {}
    for key, _t, _s, x in local:
        by_key.setdefault(key, []).append(x)
    got = {r.key: r for r in TK.ema_by_key(vals).collect()}
    for key, xs in by_key.items():
        assert got[key].n == len(xs)
        assert abs(got[key].ema_all - fold(xs)) < 1e-5
        assert abs(got[key].macd - (fold(xs[:12]) - fold(xs))) < 1e-5


def test_macd_windows_match_fold(spark):
    vals = TK.tick_values(TK.parse_ticks(_dense_ticks(spark), "value", seq_col="event_id")).cache()
    batch = {(r.key, r.window_start): r for r in TK.macd_windows(vals, "26 minutes", "1 minute").collect()}
    # brute force over the local rows
    local = sorted(map(tuple, vals.collect()), key=lambda r: (r[0], r[1], r[2]))
    wins: dict = {}
    for key, t, _s, x in local:
        last = t.replace(second=0, microsecond=0)
        for j in range(26):
            wins.setdefault((key, last - dt.timedelta(minutes=j)), []).append((t, x))
    assert len(wins) == len(batch)
    for (key, ws), items in wins.items():
        xs = [x for _, x in items]
        r = batch[(key, ws)]
        assert r.n == len(xs)
        assert abs(r.value - round(fold(xs[:12]) - fold(xs), 6)) < 1e-5
        assert r.split == items[0][0].strftime("%H:%M:%S")
    # intermediate rows: every bucket beside its windows, no more
    ranked, buckets = TK._bucketed(vals, 60)
    n = buckets.count()
    assert TK.bucket_windows(buckets, 26).count() == 26 * n and ranked.count() == len(local)


def test_ema_plan_splits_a_key(spark):
    vals = TK.tick_values(TK.parse_ticks(_dense_ticks(spark), "value", seq_col="event_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(TK.ema_by_key(vals), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = plan[: plan.index("Join")]
    # the final sum is behind an exchange on the key, the join before it is not on the key alone
    assert "hashpartitioning(key" in top and "partial_sum" in top


def test_macd_stream_26_by_1(spark):
    """The reference's window on a real stream: closed windows as in batch."""
    ticks = _dense_ticks(spark)
    src, out = scratch_path(spark, "macd-src"), scratch_path(spark, "macd-out")
    ticks.repartition(2).write.json(src)
    stream = J.source(spark, "json", path=src, schema="event_id long, value string")
    vals = TK.tick_values(TK.parse_ticks(stream, "value", seq_col="event_id"))
    held = J.closed_buckets(vals, "1 minute", "10 minutes")
    q = run_available_now(held.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint_for(spark, "macd")))
    got = {(r.key, r.window_start): r for r in J.closed_macd(spark.read.parquet(out), J.watermark_of(q), "26 minutes", "1 minute").collect()}
    batch_values = TK.tick_values(TK.parse_ticks(ticks, "value", seq_col="event_id"))
    last = batch_values.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    want = {(r.key, r.window_start): r for r in TK.macd_windows(batch_values, "26 minutes", "1 minute").collect() if r.window_end <= last}
    assert held.isStreaming and want and got.keys() == want.keys()
    assert all((got[k].n, got[k].value, got[k].split) == (want[k].n, want[k].value, want[k].split) for k in want)


def test_totals_are_not_rounded(spark):
    rows = [(i, line("k", i, 0.004, T0)) for i in range(10)]
    vals = TK.tick_values(TK.parse_ticks(spark.createDataFrame(rows, "event_id long, value string"), "value", seq_col="event_id"))
    assert TK.window_stats(vals, "26 minutes").first().total == 0.04
    assert {r.total for r in TK.window_stats(vals, "26 minutes", "1 minute").collect()} == {0.04}


def test_groups_come_in_bounded_chunks(spark):
    parsed = TK.parse_ticks(_dense_ticks(spark), "value", seq_col="event_id")
    got = TK.concat_groups(parsed, item=F.array("seq"), chunk=3).collect()
    assert max(len(r["items"]) for r in got) == 3
    assert sorted(x for r in got for x in r["items"]) == sorted(r.seq for r in parsed.collect())


def _to_folder(out):
    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return write


def _write_json(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(folder)


def test_stream_watermark_drops_late_rows(spark):
    src = scratch_path(spark, "late-src")
    schema = "key string, event_time timestamp, seq long, x double"
    _write_json(spark, src, [("k", T0, 1, 1.0), ("k", T0 + dt.timedelta(hours=3), 2, 2.0)], schema)
    stream = J.source(spark, "json", path=src, schema=schema, max_files_per_trigger=1)
    stats = J.sliding_window_stats(stream, "10 minutes", None, "30 minutes")
    out = scratch_path(spark, "late-out")
    ckpt = checkpoint_for(spark, "late")

    def writer():
        # restartable sink: the memory sink cannot resume from a checkpoint
        return stats.writeStream.outputMode("append").foreachBatch(_to_folder(out)).option("checkpointLocation", ckpt)

    run_available_now(writer())
    # a row far behind the watermark and one within the lateness bound
    _write_json(
        spark,
        src,
        [("k", T0 + dt.timedelta(minutes=5), 3, 100.0), ("k", T0 + dt.timedelta(hours=2, minutes=45), 4, 5.0),
         ("k", T0 + dt.timedelta(hours=5), 5, 7.0)],
        schema,
    )
    run_available_now(writer())
    got = {(str(r.window_start), r.n, r.total) for r in spark.read.parquet(out).collect()}
    # first window keeps only its on-time row; the late 100.0 is dropped
    assert (str(T0), 1, 1.0) in got
    assert all(total != 101.0 for _, _, total in got)
    assert (str(T0 + dt.timedelta(hours=2, minutes=40)), 1, 5.0) in got


def test_stream_word_count_update_mode(spark):
    src = scratch_path(spark, "wc-src")
    spark.createDataFrame([("a b a",)], "value string").write.text(src)
    lines = J.source(spark, "text", path=src)
    counts = J.word_count_stream(lines, "value")
    out = scratch_path(spark, "wc-out")
    ckpt = checkpoint_for(spark, "wc")
    w = lambda: counts.writeStream.outputMode("update").foreachBatch(_to_folder(out)).option(
        "checkpointLocation", ckpt
    )
    run_available_now(w())
    spark.createDataFrame([("b c",)], "value string").write.mode("append").text(src)
    run_available_now(w())
    got = sorted((r.word, r["count"]) for r in spark.read.parquet(out).collect())
    # update mode: the first batch's rows, then only changed words
    assert got == sorted([("a", 2), ("b", 1), ("b", 2), ("c", 1)])


def test_fanout_of_kafka_rows_and_replay(spark):
    """Binary key and value with partition and offset, as a Kafka source gives
    them, through the text pairs (S7, P5) into both tables and the topic."""
    rows = [(None, bytearray(line("k", i, 3.0 + i, T0).encode()), 0, i) for i in (1, 2)]
    batch = as_text_pairs(spark.createDataFrame(rows, "key binary, value binary, partition int, offset long"))
    tables = J.fanout_tables(spark, "quire_test", f"_{unique_name('t')}", scratch_path(spark, "fanout-db"))
    out = scratch_path(spark, "fanout")
    fn = J.fanout_batch(tables, out)
    fn(batch, 0)
    fn(batch, 0)  # replay of the same batch id
    fn(batch.limit(1), 1)
    assert spark.table(tables["indexes"]).count() == 4 + 2
    assert spark.table(tables["parameters"]).count() == 2 + 1
    assert spark.read.json(f"{out}").count() == 4 + 2
    assert dict(spark.table(tables["indexes"]).dtypes)["time"] == "timestamp"


def test_stream_word_count_complete_mode(spark):
    src, out = scratch_path(spark, "wcc-src"), scratch_path(spark, "wcc-out")
    spark.createDataFrame([("a b a",), ("b",)], "value string").write.text(src)
    counts = J.word_count_stream(J.source(spark, "text", path=src), "value")
    run_available_now(counts.writeStream.outputMode("complete").foreachBatch(_to_folder(out)).option("checkpointLocation", checkpoint_for(spark, "wcc")))
    assert sorted((r.word, r["count"]) for r in spark.read.parquet(f"{out}/batch_id=0").collect()) == [("a", 2), ("b", 2)]


@pytest.mark.parametrize("layout", ["file", "files", "partitions", "no rows"])
def test_stream_word_count_of_a_table_in_any_layout(spark, layout):
    from quire.plans.streams import stream_word_count

    folder = _documents(spark, layout)
    got = sorted((r.word, r["count"]) for r in stream_word_count(spark, folder).collect())
    assert got == ([] if layout == "no rows" else [("a", 4), ("b", 2), ("c", 1)])


def test_stream_word_text_of_a_table_in_several_files(spark):
    from quire.plans.streams import stream_word_text

    got = sorted(map(tuple, stream_word_text(spark, _documents(spark, "files")).collect()))
    assert got == [("a", "4"), ("b", "2"), ("c", "1")]


def _documents(spark, layout: str) -> str:
    """A data folder of a documents table: one file, a folder of several files, one
    of partitions, one of a file without rows; and another table beside it."""
    folder = scratch_path(spark, "tables")
    path = f"{folder}/documents.parquet"
    docs = spark.createDataFrame([(1, "a b a", "x"), (2, "B c", "y"), (3, None, "x"), (None, "a A", "y")], "doc_id long, text string, lang string")
    if layout == "file":
        import os

        import pyarrow.parquet as pq

        os.makedirs(folder)
        pq.write_table(docs.toArrow(), path)
    elif layout == "files":
        docs.repartition(3).write.parquet(path)
    elif layout == "partitions":
        docs.write.partitionBy("lang").parquet(path)
    else:
        docs.limit(0).write.parquet(path)
    spark.createDataFrame([("z",)], "text string").write.parquet(f"{folder}/pages.parquet")
    return folder


def test_a_time_limit_is_only_on_request(spark):
    src = scratch_path(spark, "slow-src")
    spark.range(4).write.parquet(src)
    slow = spark.readStream.schema("id long").parquet(src)

    def wait(batch, _):
        import time

        time.sleep(3)

    w = lambda: slow.writeStream.foreachBatch(wait).option("checkpointLocation", checkpoint_for(spark, "slow"))
    with pytest.raises(TimeoutError):
        run_available_now(w(), timeout_s=1)
    q = run_available_now(w())
    assert q.exception() is None and "FileStreamSource" in stream_plan_text(q) + str(q.lastProgress)


def test_memory_sink_queried_by_sql(spark):
    from quire.plans.streams import run_to_memory

    src = scratch_path(spark, "kv-src")
    _write_json(spark, src, [("2018-01-01T00:00:00", str(v)) for v in range(1, 33)], "key string, value string")
    kv = J.source(spark, "json", path=src, schema="key string, value string")
    name = run_to_memory(kv, "kv", "append")
    assert spark.sql(f"SELECT count(*) AS n, sum(CAST(value AS INT)) AS s FROM {name}").first() == (32, 528)
