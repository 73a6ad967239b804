from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.operators import ticks as TK
from quire.session import scratch_path
from quire.streaming import jobs as J
from quire.streaming.bars import ROCKSDB, on_rocksdb, open_bars, timed_bars
from quire.streaming.runner import checkpoint_for, run_available_now

T0 = dt.datetime(2024, 3, 1, 9, 0)
SCHEMA = "key string, event_time timestamp, seq long, x double"
at = lambda m, s=0: T0 + dt.timedelta(minutes=m, seconds=s)


def _append(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(folder)


def _files(df, out, ckpt):
    return run_available_now(df.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", ckpt))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_closed_and_open_windows_are_all(spark):
    """At every stop the sink and the state together hold each window once."""
    src, out, ckpt = scratch_path(spark, "tail-src"), scratch_path(spark, "tail-out"), checkpoint_for(spark, "tail")
    first = [("k", at(m, m), m, m / 4) for m in range(0, 100, 3)] + [("j", at(7), 1000, 9.0)]
    _append(spark, src, first)
    stats = J.sliding_window_stats(J.source(spark, "json", path=src, schema=SCHEMA), "10 minutes", "5 minutes", "20 minutes")
    _files(stats, out, ckpt)
    everything = lambda: _rows(spark.read.parquet(out).unionByName(J.open_windows(spark, ckpt)))
    want = lambda rows: _rows(TK.window_stats(spark.createDataFrame(rows, SCHEMA), "10 minutes", "5 minutes"))
    assert everything() == want(first) and J.open_windows(spark, ckpt).count() > 0
    second = [("k", at(m), 500 + m, 1.0) for m in range(85, 200, 5)]
    _append(spark, src, second)
    _files(stats, out, ckpt)
    assert everything() == want(first + second)


def test_a_tick_is_a_state_row(spark):
    """Equal ticks are counted, none is lost, and a batch updates only its own rows."""
    src, out, ckpt = scratch_path(spark, "held-src"), scratch_path(spark, "held-out"), checkpoint_for(spark, "held")
    first = [("k", at(0, s % 60), s, 1.0) for s in range(300)] + [("k", at(1), 7, 2.0)] * 3
    _append(spark, src, first)
    held = J.closed_buckets(J.source(spark, "json", path=src, schema=SCHEMA), "30 minutes", "1 hour")
    _files(held, out, ckpt)
    assert J.open_ticks(spark, ckpt).count() == 303 and spark.read.schema(held.schema).parquet(out).count() == 0
    second = [("k", at(2), 400, 5.0), ("k", at(200), 401, 6.0)]
    _append(spark, src, second)
    q = _files(held, out, ckpt)
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress) == 2  # not the 301 rows before
    sink = spark.read.parquet(out)
    assert (sink.count(), J.open_ticks(spark, ckpt).count()) == (304, 1)
    got = _rows(sink.unionByName(J.open_ticks(spark, ckpt)).select("key", "event_time", "seq", "x"))
    assert got == sorted(first + second)


def test_closed_macd_needs_a_watermark(spark):
    ticks = spark.createDataFrame([("k", at(0), 1, 1.0)], SCHEMA)
    with pytest.raises(ValueError, match="watermark"):
        J.closed_macd(ticks, None, "26 minutes", "1 minute")


def _bars(rows):
    out = {}
    for key, t, seq, x in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        bucket = (key, t.replace(minute=t.minute // 30 * 30, second=0, microsecond=0))
        n, o, high, low, _ = out.get(bucket, (0, x, x, x, x))
        out[bucket] = (n + 1, o, max(high, x), min(low, x), x)
    return sorted((*k, *v) for k, v in out.items())


def test_bars_by_timers(spark):
    """List state is appended to over batches, a timer releases it, a late tick
    is dropped, and the open bars come from the state."""
    own = on_rocksdb(spark)
    assert own.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB
    src, out, ckpt = scratch_path(spark, "bars-src"), scratch_path(spark, "bars-out"), checkpoint_for(spark, "bars")
    first = [("k", at(m, 5), 100 - m, float(m % 7)) for m in range(40)] + [("j", at(3), 2, 4.0), ("j", at(3), 1, 5.0)]
    _append(spark, src, first)
    bars = timed_bars(J.source(own, "json", path=src, schema=SCHEMA), "30 minutes", "15 minutes")
    _files(bars, out, ckpt)
    everything = lambda: _rows(spark.read.schema(bars.schema).parquet(out).unionByName(open_bars(spark, ckpt, "30 minutes")))
    assert everything() == _bars(first)
    assert spark.read.schema(bars.schema).parquet(out).count() == 0  # 9:39 less 15 minutes is before 9:30
    second = [("k", at(26), 900, -3.0), ("k", at(75), 901, 8.0)]
    _append(spark, src, second)
    _files(bars, out, ckpt)
    assert everything() == _bars(first + second)
    assert {r.key for r in spark.read.parquet(out).collect()} == {"k", "j"}
    _append(spark, src, [("k", at(1), 902, 99.0), ("k", at(80), 903, 1.0)])  # the first is behind the watermark
    _files(bars, out, ckpt)
    assert everything() == _bars(first + second + [("k", at(80), 903, 1.0)])
    state = spark.read.format("statestore").option("stateVarName", "ticks").option("flattenCollectionTypes", True).load(ckpt)
    assert state.select(F.count(F.lit(1))).first()[0] == 2  # the open bar's ticks, one state row each
