"""Queries over stored summaries, SQL-defined functions, refused lines and the
sources' parameters, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from quire.operators import summaries as S
from quire.operators.sql_functions import flatten_statistics_sql
from quire.plans import fixtures as FX
from quire.session import scratch_path
from quire.sources.files import csv_scan, from_rows, write_format
from quire.sources.quarantine import scan_with_rejects
from quire.sources.tables import load



def _day() -> Column:
    return F.to_date("o_orderdate")


def _month() -> Column:
    return F.date_format("day", "yyyy-MM")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written as a table and read back, as a job of another day would."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + A7: exact distinct customers per day, month and in all, from daily
    bitmaps; the sum of distinct ids needs no more than the united bitmap."""
    daily = _stored(S.daily_bitmaps(load(spark, sf_dir, "orders"), {"day": _day()}, "o_custkey"), "customer-bitmaps")
    monthly = _stored(S.rollup_bitmaps(daily, {"period": _month()}), "monthly-bitmaps")
    total = S.rollup_bitmaps(monthly, {"period": F.lit("all")})
    days = daily.select(F.col("day").cast("string").alias("period"), "bucket", "bits")
    levels = {"day": days, "month": monthly, "all": total}
    parts = [S.count_bitmaps(b, ["period"]).select(F.lit(n).alias("level"), "period", F.col("ids").alias("customers")) for n, b in levels.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


DISTINCT_ROLLUP_SQL = """
SELECT 'day' AS level, strftime(o_orderdate, '%Y-%m-%d') AS period, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL
UNION ALL SELECT 'month', strftime(o_orderdate, '%Y-%m'), count(DISTINCT o_custkey) FROM orders GROUP BY ALL
UNION ALL SELECT 'all', 'all', count(DISTINCT o_custkey) FROM orders
"""

HLL_BOUND = 0.05  # over six standard errors of the sketch


def distinct_sketch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: HyperLogLog sketches stored per day and united over months and in all;
    whether each estimate is within the bound of the exact count."""
    orders = load(spark, sf_dir, "orders")
    daily = _stored(S.distinct_sketches(orders, {"day": _day()}, "o_custkey"), "customer-sketches")
    exact = _stored(S.daily_bitmaps(orders, {"day": _day()}, "o_custkey"), "customer-bitmaps")
    parts = []
    for period in (_month(), F.lit("all")):
        counted = S.count_bitmaps(S.rollup_bitmaps(exact, {"period": period}), ["period"])
        parts.append(S.estimate_distinct(daily, {"period": period}).join(counted, "period"))
    both = parts[0].unionByName(parts[1])
    return both.select("period", F.col("ids").alias("customers"), (F.abs(F.col("estimate") - F.col("ids")) <= HLL_BOUND * F.col("ids") + 1).alias("within"))


DISTINCT_SKETCH_SQL = """
SELECT strftime(o_orderdate, '%Y-%m') AS period, count(DISTINCT o_custkey) AS customers, true AS within FROM orders GROUP BY ALL
UNION ALL SELECT 'all', count(DISTINCT o_custkey), true FROM orders
"""

KLL_BOUND = 0.04  # of a group's rows
CUTS = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def nation_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 per group: quartiles of order values per nation from KLL sketches stored
    per nation and month; whether each cut's true rank is within the bound."""
    customers = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    orders = load(spark, sf_dir, "orders").select("o_custkey", F.col("o_totalprice").alias("price"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    rows = orders.join(customers, "o_custkey")
    stored = _stored(S.quantile_sketches(rows, {"nation": F.col("nation"), "month": F.col("month")}, "price"), "price-sketches")
    cuts = _stored(S.merged_quantiles(stored, ["nation"], CUTS), "price-cuts")  # a row per nation
    checked = rows.join(cuts, "nation").groupBy("nation").agg(
        F.count(F.lit(1)).alias("orders"), F.max("rows").alias("n"),
        *[F.struct(F.count_if(F.col("price") < F.col(c)).alias("below"), F.count_if(F.col("price") <= F.col(c)).alias("upto")).alias(c) for c in CUTS],
    )
    slack = KLL_BOUND * F.col("n") + 1
    near = [((F.col(c)["upto"] >= p * F.col("n") - slack) & (F.col(c)["below"] <= p * F.col("n") + slack)).alias(f"{c}_within") for c, p in CUTS.items()]
    return checked.select("nation", "orders", *near)


NATION_QUARTILES_SQL = """
SELECT c_nationkey AS nation, count(*) AS orders, true AS q1_within, true AS q2_within, true AS q3_within
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""


def stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 + U7: statistics messages flattened by a SQL table function."""
    return flatten_statistics_sql(spark, FX.statistics_messages(spark, sf_dir)).withColumn("quotaType", F.lit("[]"))


TICK_CSV = StructType(
    [StructField("event_id", LongType()), StructField("key", StringType()), StructField("value", DoubleType()), StructField("user_id", LongType())]
)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 + S2: daily CSV files with broken lines: accepted rows, refused lines
    and the counts observed in the same pass. Of the events, ids divisible by 97
    lack fields, those by 89 hold text for a number."""
    ev = load(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 89 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    whole = F.concat_ws(",", F.col("event_id").cast("string"), "event_type", value, F.col("user_id").cast("string"))
    line = F.when(F.col("event_id") % 97 == 0, F.concat_ws(",", F.col("event_id").cast("string"), "event_type")).otherwise(whole)
    path = scratch_path(spark, "daily-lines")
    ev.select(line.alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("day")).repartition("day").write.partitionBy("day").text(path)
    good, bad, counts = scan_with_rejects(spark, f"{path}/day=*/*.txt", TICK_CSV, scratch_path(spark, "quarantine"), header=False)
    rows = good.select(F.lit("accepted").alias("part"), "event_id", "key", "value", F.lit(None).cast("string").alias("line"))
    none = lambda kind: F.lit(None).cast(kind)
    rows = rows.unionByName(bad.select(F.lit("refused").alias("part"), none("long").alias("event_id"), none("string").alias("key"), none("double").alias("value"), "line"))
    seen = spark.createDataFrame([(f"{k} lines", v) for k, v in counts.items()], "part string, event_id long")
    return rows.unionByName(seen, allowMissingColumns=True)


_LINE = "event_id || ',' || event_type || CASE WHEN event_id % 97 = 0 THEN '' ELSE ',n/a,' || user_id END"
CSV_QUARANTINE_SQL = f"""
SELECT 'accepted' AS part, event_id, event_type AS key, value, CAST(NULL AS VARCHAR) AS line FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
UNION ALL SELECT 'refused', NULL, NULL, NULL, {_LINE} FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0
UNION ALL SELECT 'read lines', count(*), NULL, NULL, NULL FROM events
UNION ALL SELECT 'refused lines', count(*) FILTER (WHERE event_id % 97 = 0 OR event_id % 89 = 0), NULL, NULL, NULL FROM events
UNION ALL SELECT 'accepted lines', count(*) FILTER (WHERE event_id % 97 <> 0 AND event_id % 89 <> 0), NULL, NULL, NULL FROM events
"""


def csv_lines_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P16: all lines as CSV with a header, scanned with inferred types and
    dealt over more tasks, then summed per return flag."""
    path = scratch_path(spark, "lines-csv")
    write_format(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity", "l_shipdate"), "csv", path, header="true")
    lines = csv_scan(spark, path, repartition=int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = dict(lines.dtypes)
    assert kinds["l_orderkey"] in ("int", "bigint") and kinds["l_quantity"] == "double" and kinds["l_shipdate"].startswith(("date", "timestamp")), kinds
    return lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
        F.max(F.col("l_orderkey").cast("long")).alias("last_order"), F.max(F.to_date("l_shipdate")).alias("last_day"),
    )


CSV_LINES_SQL = """
SELECT l_returnflag, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       max(CAST(l_orderkey AS BIGINT)) AS last_order, CAST(max(l_shipdate) AS DATE) AS last_day
FROM lineitem GROUP BY ALL
"""

KINDS = ("click", "view", "purchase", "none of these")


def rows_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A driver-side list of names as a table, joined to the events."""
    names = from_rows(spark, KINDS, "event_type")
    ev = load(spark, sf_dir, "events").select("event_type", "user_id")
    return names.join(ev, "event_type", "left").groupBy("event_type").agg(F.count("user_id").alias("events"))


ROWS_LOOKUP_SQL = f"""
SELECT n.event_type, count(user_id) AS events FROM (VALUES {', '.join(f"('{k}')" for k in KINDS)}) n(event_type)
LEFT JOIN events e ON n.event_type = e.event_type GROUP BY ALL
"""

QUERIES = {
    f.__name__: f for f in (distinct_rollup, distinct_sketch_range, nation_quartiles, stats_sql, csv_quarantine, csv_lines_inferred, rows_lookup)
}
ORACLES = {
    "distinct_rollup": DISTINCT_ROLLUP_SQL, "distinct_sketch_range": DISTINCT_SKETCH_SQL, "nation_quartiles": NATION_QUARTILES_SQL,
    "csv_quarantine": CSV_QUARANTINE_SQL, "csv_lines_inferred": CSV_LINES_SQL, "rows_lookup": ROWS_LOOKUP_SQL,
}
