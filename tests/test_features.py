from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from quire.operators import summaries as S
from quire.operators.sql_functions import create_sql_functions, flatten_statistics_sql
from quire.operators.stats_json import flatten_statistics
from quire.plans import fixtures as FX
from quire.session import scratch_path
from quire.sources.files import csv_scan
from quire.sources.quarantine import scan_with_rejects
from quire.streaming import jobs as J
from quire.streaming.listener import ProgressTable
from quire.streaming.runner import checkpoint_for, run_available_now


def _visits(spark):
    rng = random.Random(3)
    ids = [rng.choice([0, 1, 32767, 32768, 32769, 10**6, 10**12 + 5, rng.randrange(50_000)]) for _ in range(3000)]
    rows = [(f"2024-0{1 + i % 3}-{1 + i % 20:02d}", v, float(rng.gauss(0, 1) + i % 3)) for i, v in enumerate(ids)] + [("2024-01-01", None, None)]
    return rows, spark.createDataFrame(rows, "day string, id long, x double").repartition(5)


def test_bitmaps_are_exact_at_every_level(spark):
    rows, df = _visits(spark)
    daily = S.daily_bitmaps(df, {"day": F.col("day")}, "id")
    months = S.rollup_bitmaps(daily, {"month": F.left("day", F.lit(7))})
    count = lambda key: {k: len({v for d, v, _ in rows if v is not None and key(d) == k}) for k in {key(d) for d, _, _ in rows}}
    assert {r.day: r.ids for r in S.count_bitmaps(daily, ["day"]).collect()} == count(lambda d: d)
    assert {r.month: r.ids for r in S.count_bitmaps(months, ["month"]).collect()} == count(lambda d: d[:7])
    assert S.count_bitmaps(S.rollup_bitmaps(months, {"all": F.lit(1)})).first().ids == count(lambda d: 0)[0]
    plan = S.count_bitmaps(months, ["month"])._jdf.queryExecution().toString()
    assert "Expand" not in plan


def test_sketches_unite(spark):
    rows, df = _visits(spark)
    daily = S.distinct_sketches(df, {"day": F.col("day")}, "id")
    exact = len({v for _, v, _ in rows if v is not None})
    assert abs(S.estimate_distinct(daily, {"all": F.lit(1)}).first().estimate - exact) <= 0.05 * exact
    one = S.estimate_distinct(daily.where("day = '2024-01-01'"), {"all": F.lit(1)}).first().estimate
    assert one == len({v for d, v, _ in rows if d == "2024-01-01" and v is not None})  # small sets are exact


def test_quantiles_of_merged_sketches(spark):
    rows, df = _visits(spark)
    stored = S.quantile_sketches(df, {"month": F.left("day", F.lit(7)), "day": F.col("day")}, "x")
    for r in S.merged_quantiles(stored, ["month"], {"low": 0.1, "mid": 0.5}).collect():
        xs = sorted(x for d, _, x in rows if d[:7] == r.month and x is not None)
        assert r["rows"] == len(xs)
        for p, cut in ((0.1, r.low), (0.5, r.mid)):
            assert abs(sum(x <= cut for x in xs) / len(xs) - p) < 0.04


def test_sql_functions(spark, sf_small):
    create_sql_functions(spark)
    values = ", ".join(str(v) for v in (1, 2, 3, 4))
    got = spark.sql(f"SELECT quartile_score(v, 1, 2, 3, true) AS r, quartile_score(v, 1, 2, 3, false) AS f FROM VALUES {values} AS t(v)").collect()
    assert [(r.r, r.f) for r in got] == [(4, 1), (3, 2), (2, 3), (1, 4)]
    messages = FX.statistics_messages(spark, sf_small)
    extra = spark.createDataFrame([("a+dbcode=hgjd", "{no json"), (None, None), ("a+dbcode=x", '{"returndata": {"datanodes": [], "wdnodes": []}}')], "key string, value string")
    both = messages.unionByName(extra)
    want = flatten_statistics(both).drop("quotaType")
    rows = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)
    assert rows(flatten_statistics_sql(spark, both)) == rows(want) and want.count() > 100


KIND = StructType([StructField("a", LongType()), StructField("b", DoubleType())])


def test_refused_lines_are_kept(spark):
    path = scratch_path(spark, "lines")
    lines = ["1,2.5", "2,x", "3", "4,5,6", "", "5,", ",7", "9999999999999999999,1", "6,1e3"]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(path)
    good, bad, counts = scan_with_rejects(spark, path, KIND, scratch_path(spark, "kept"), header=False)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, 2.5), (5, None), (None, 7.0), (6, 1000.0)], key=str)
    assert sorted(r.line for r in bad.collect()) == ["2,x", "3", "4,5,6", "9999999999999999999,1"]
    assert all(r.file.endswith(".txt") for r in bad.collect())
    assert counts == {"read": 8, "refused": 4, "accepted": 4}


def test_nothing_refused_and_an_empty_file(spark):
    for lines in (["1,2"], []):
        path = scratch_path(spark, "lines")
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
        good, bad, counts = scan_with_rejects(spark, path, KIND, scratch_path(spark, "kept"), header=False)
        assert (good.count(), bad.count()) == (len(lines), 0) and counts["read"] == len(lines)


def test_repartition_of_a_scan(spark):
    path = scratch_path(spark, "csv")
    spark.range(100).write.option("header", "true").csv(path)
    assert csv_scan(spark, path, repartition=7).rdd.getNumPartitions() == 7


@pytest.mark.parametrize("held", [1, 256])
def test_progress_of_every_batch(spark, held):
    src, path, out = scratch_path(spark, "p-src"), scratch_path(spark, "progress"), scratch_path(spark, "p-out")
    t0 = dt.datetime(2024, 1, 1)
    rows = [("k", t0 + dt.timedelta(minutes=i), i, 1.0) for i in range(90)]
    schema = "key string, event_time timestamp, seq long, x double"
    spark.createDataFrame(rows, schema).repartition(3).write.json(src)
    stats = J.sliding_window_stats(J.source(spark, "json", path=src, schema=schema, max_files_per_trigger=1), "10 minutes", None, "100 minutes")
    listener = ProgressTable(spark, path, held=held)
    spark.streams.addListener(listener)
    try:
        q = run_available_now(stats.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint_for(spark, "p")))
        listener.await_end(q)
    finally:
        listener.close()
    table = [r for r in listener.table().orderBy("batch").collect() if r.run == str(q.runId)]
    assert sum(r.input_rows for r in table) == 90 and sum(r.input_rows > 0 for r in table) == 3
    assert [r.batch for r in table] == list(range(len(table)))
    assert max(r.watermark for r in table) == J.watermark_of(q) and table[-1].state_rows == 9
