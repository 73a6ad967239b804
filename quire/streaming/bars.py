"""Price bars of ticks held in list state and released by timers.

The state of a (key, bucket) is a list on RocksDB: a batch appends its ticks and
rewrites none. A timer at the bucket's end, set once, fires when the watermark
passes it; the list then becomes one row and is cleared.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.ticks import _seconds

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TICK = "at long, seq long, x double"
BAR = "key string, bar_end timestamp, n long, open double, high double, low double, close double"


def on_rocksdb(spark: SparkSession) -> SparkSession:
    """A session of its own whose streaming queries keep their state on RocksDB."""
    own = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return own


def _processor():
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Bars(StatefulProcessor):  # local, so that workers need no copy of this module
        def init(self, handle) -> None:
            self.handle = handle
            self.ticks = handle.getListState("ticks", TICK)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            if not self.ticks.exists():
                self.handle.registerTimer(int(key[1].timestamp() * 1000))
            for frame in rows:
                self.ticks.appendList(list(frame[["at", "seq", "x"]].itertuples(index=False, name=None)))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            first = last = None
            n, high, low = 0, float("-inf"), float("inf")
            for at, seq, x in self.ticks.get():
                n, high, low = n + 1, max(high, x), min(low, x)
                first = min(first or (at, seq, x), (at, seq, x))
                last = max(last or (at, seq, x), (at, seq, x))
            self.ticks.clear()
            yield pd.DataFrame({"key": [key[0]], "bar_end": [key[1]], "n": [n], "open": [first[2]], "high": [high], "low": [low], "close": [last[2]]})

        def close(self) -> None:
            pass

    return Bars()


def timed_bars(values: DataFrame, length: str, lateness: str) -> DataFrame:
    """(key, bar_start, n, open, high, low, close) of every bucket of ``length``
    that the watermark has passed, from ticks (key, event_time, seq, x) on a
    stream; ties of time are ordered by sequence. Ticks that are themselves behind
    the watermark are dropped."""
    s = _seconds(length)
    timed = values.withWatermark("event_time", lateness)
    end = F.timestamp_seconds((F.floor(F.unix_seconds("event_time") / s) + 1) * s)
    keyed = timed.select("key", end.alias("bar_end"), "event_time", F.unix_micros("event_time").alias("at"), "seq", "x")
    bars = keyed.groupBy("key", "bar_end").transformWithStateInPandas(_processor(), BAR, "append", "EventTime")
    return bars.select("key", _start("bar_end", s), "n", "open", "high", "low", "close")


def _start(end: str, seconds: int):
    return (F.col(end) - F.expr(f"INTERVAL {seconds} SECONDS")).alias("bar_start")


def open_bars(spark: SparkSession, checkpoint: str, length: str) -> DataFrame:
    """The bars whose ticks still wait in the list state of the checkpoint."""
    state = spark.read.format("statestore").option("stateVarName", "ticks").option("flattenCollectionTypes", True).load(checkpoint)
    t = state.select("key.key", "key.bar_end", "list_element.*")
    order = F.struct("at", "seq", "x")
    bars = t.groupBy("key", "bar_end").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("x", order).alias("open"), F.max("x").alias("high"), F.min("x").alias("low"), F.max_by("x", order).alias("close")
    )
    return bars.select("key", _start("bar_end", _seconds(length)), "n", "open", "high", "low", "close")
