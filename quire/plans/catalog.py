"""The named queries: each takes (spark, sf_dir) and returns a DataFrame over
the driver tables, and most have an equivalent DuckDB SQL oracle.

Defaults for the retail view (SURVEY §7.2): country AMERICA, invoices after
1995-01-09, recency measured to 2001-12-31.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import aggregates as A
from quire.operators import rfm as R
from quire.operators import ticks as TK
from quire.operators.cdc import cdc_apply, cdc_decode
from quire.operators.ranking import quantiles
from quire.operators.sql_functions import rfm_score_sql
from quire.operators.stats_json import QUOTA_DDL, flatten_statistics
from quire.operators.udfs import rfm_score_udf, split_with_udf
from quire.operators.words import word_count
from quire.plans import features as FT
from quire.plans import fixtures as FX
from quire.plans import streams as ST
from quire.plans.transactions import TX_SQL, transactions
from quire.session import scratch_path
from quire.sources import connectors as C
from quire.sources.files import csv_scan, range_numbers, read_format, write_format
from quire.sources.tables import load

COUNTRY = "AMERICA"
AFTER = "1995-01-09"
AS_OF = "2001-12-31"
CUSTOMER = "5"  # P11: one customer's lines (a customer present at sf0.01)
MACD_WINDOW = ("780 minutes", "30 minutes")  # oracle-checked MACD window size
RFM_EXACT = 0.0  # relative error of the scored queries (exact, oracle-checked)

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- retail view


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.clean_transactions(_tx(spark, sf_dir), COUNTRY, AFTER)


def _rfm(spark: SparkSession, sf_dir: str, frequency: str = "lines") -> DataFrame:
    return R.rfm(_clean(spark, sf_dir), AS_OF, frequency)


CLEAN_SQL = f"""
SELECT InvoiceNo, StockCode, Description, Quantity,
       CAST(date_trunc('second', InvoiceDate) AS TIMESTAMP) AS InvoiceDate,
       UnitPrice, CAST(CustomerID AS BIGINT) AS CustomerID, Country
FROM ({TX_SQL}) tx
WHERE Country = '{COUNTRY}' AND Quantity > 0
  AND date_trunc('second', InvoiceDate) > TIMESTAMP '{AFTER}' AND CustomerID IS NOT NULL
"""

RFM_SQL = f"""
SELECT CustomerID,
       CAST(date_diff('day', max(CAST(InvoiceDate AS DATE)), DATE '{AS_OF}') AS INTEGER) AS Recency,
       count(*) AS Frequency,
       CAST(sum(CAST(CAST(UnitPrice AS VARCHAR) AS DECIMAL(24,10)) * CAST(Quantity AS DECIMAL(11,0))) AS DOUBLE) AS Monetary
FROM ({CLEAN_SQL}) c GROUP BY CustomerID
"""

RFM_INVOICES_SQL = RFM_SQL.replace("count(*) AS Frequency", "count(DISTINCT InvoiceNo) AS Frequency")


def _disc(col: str, p: float) -> str:
    return f"(SELECT quantile_disc({col}, {p}) FROM rfm)"


def _score_sql(select: str) -> str:
    q = {c: [_disc(c, p) for p in (0.25, 0.5, 0.75)] for c in ("Recency", "Frequency", "Monetary")}

    def r(c: str) -> str:
        a, b, d = q[c]
        return f"CAST(CASE WHEN {c} <= {a} THEN 4 WHEN {c} <= {b} THEN 3 WHEN {c} <= {d} THEN 2 ELSE 1 END AS INTEGER)"

    def fm(c: str) -> str:
        a, b, d = q[c]
        return f"CAST(CASE WHEN {c} <= {a} THEN 1 WHEN {c} <= {b} THEN 2 WHEN {c} <= {d} THEN 3 ELSE 4 END AS INTEGER)"

    scored = (
        f"SELECT *, {r('Recency')} AS R_Quartile, {fm('Frequency')} AS F_Quartile, {fm('Monetary')} AS M_Quartile "
        "FROM rfm"
    )
    return (
        f"WITH rfm AS ({RFM_SQL}), s0 AS ({scored}), "
        "scored AS (SELECT *, CAST(R_Quartile AS VARCHAR) || CAST(F_Quartile AS VARCHAR) || CAST(M_Quartile AS VARCHAR) "
        "AS RFMScore FROM s0) " + select
    )


# ----------------------------------------------------------------- CSV / range


def _flight_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 written as CSV and scanned with header and inferred types."""
    path = scratch_path(spark, "flights")
    write_format(FX.flights(spark, sf_dir), "csv", path, header="true")
    return csv_scan(spark, path)


def csv_flight_top5_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + O2 + O3: the five nations with the most lines."""
    lines = F.sum("count").alias("lines")
    per_nation = _flight_csv(spark, sf_dir).groupBy(F.col("DEST_COUNTRY_NAME").alias("nation")).agg(lines)
    return per_nation.orderBy(F.desc("lines"), "nation").limit(5)


def csv_flight_top5_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a temp view and SQL text."""
    _flight_csv(spark, sf_dir).createOrReplaceTempView("nation_lines")
    return spark.sql("SELECT DEST_COUNTRY_NAME AS nation, sum(count) AS lines FROM nation_lines GROUP BY 1 ORDER BY lines DESC, nation LIMIT 5")


FLIGHT_TOP5_SQL = """
SELECT n.n_name AS nation, CAST(count(*) AS BIGINT) AS lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY n.n_name ORDER BY lines DESC, nation LIMIT 5
"""


def range_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + P10: ``range(n)`` with n = the number of orders, even numbers."""
    n = load(spark, sf_dir, "orders").count()
    return range_numbers(spark, n).where("number % 2 = 0")


RANGE_EVEN_SQL = """
SELECT range AS number FROM range((SELECT count(*) FROM orders)) WHERE range % 2 = 0
"""


# --------------------------------------------------------------- aggregates


def clean_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.distinct_counts(_clean(spark, sf_dir))


def distinct_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 as SQL text over a temp view."""
    _clean(spark, sf_dir).createOrReplaceTempView("cleaned_lines")
    counts = ", ".join(f"count(DISTINCT {c}) AS {n}" for c, n in (("InvoiceNo", "invoices"), ("StockCode", "products"), ("CustomerID", "customers")))
    return spark.sql(f"SELECT {counts} FROM cleaned_lines")


DISTINCT_SQL = f"""
SELECT count(DISTINCT InvoiceNo) AS invoices, count(DISTINCT StockCode) AS products,
       count(DISTINCT CustomerID) AS customers
FROM ({CLEAN_SQL}) c
"""


def basic_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.basic_aggs(_tx(spark, sf_dir).filter(F.col("Quantity") > 0))


BASIC_SQL = f"""
SELECT count(StockCode) AS count_stockcode, count(*) AS count_rows,
       min(Quantity) AS min_quantity, max(Quantity) AS max_quantity,
       CAST(sum(Quantity) AS BIGINT) AS sum_quantity,
       CAST(sum(DISTINCT Quantity) AS BIGINT) AS sum_distinct_quantity,
       avg(Quantity) AS avg_quantity, avg(Quantity) AS mean_quantity,
       sum(Quantity) / count(Quantity) AS purchases_per_transaction,
       max(InvoiceDate) AS last_date
FROM ({TX_SQL}) tx WHERE Quantity > 0
"""


def spread_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.spread_aggs(_tx(spark, sf_dir))


SPREAD_SQL = f"""
SELECT round(var_pop(Quantity), 4) AS var_pop, round(var_samp(Quantity), 4) AS var_samp,
       round(stddev_pop(Quantity), 4) AS stddev_pop, round(stddev_samp(Quantity), 4) AS stddev_samp
FROM ({TX_SQL}) tx
"""


def collect_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.collect_aggs(_tx(spark, sf_dir))


COLLECT_SQL = f"""
SELECT InvoiceNo,
       array_to_string(list_sort(list(DISTINCT Country)), ',') AS countries,
       array_to_string(list_sort(list(StockCode)), ',') AS stock_codes,
       count(*) AS lines
FROM ({TX_SQL}) tx GROUP BY InvoiceNo
"""


def collect_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.collect_set_global(_tx(spark, sf_dir))


COLLECT_COUNTRIES_SQL = f"""
SELECT array_to_string(list_sort(list(DISTINCT Country)), ',') AS countries FROM ({TX_SQL}) tx
"""


def approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: the exact count and whether the sketch is within its bound."""
    return A.approx_distinct_checked(_tx(spark, sf_dir), "StockCode", 0.1)


APPROX_SQL = f"SELECT count(DISTINCT StockCode) AS exact, true AS within FROM ({TX_SQL}) tx"


def group_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_two_keys(_tx(spark, sf_dir))


GROUP_TWO_SQL = f"""
SELECT InvoiceNo, CustomerID AS CustomerId, count(*) AS count FROM ({TX_SQL}) tx GROUP BY InvoiceNo, CustomerID
"""


def last_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.last_purchase(_clean(spark, sf_dir))


LAST_PURCHASE_SQL = f"""
SELECT CustomerID, max(CAST(InvoiceDate AS DATE)) AS LastPurchaseDate FROM ({CLEAN_SQL}) c GROUP BY CustomerID
"""


# ----------------------------------------------------------------------- RFM


def rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rfm(spark, sf_dir)


def rfm_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rfm_joined(_clean(spark, sf_dir), AS_OF)


def rfm_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rfm(spark, sf_dir, "invoices")


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer's cleaned lines, the int key compared as text."""
    return _clean(spark, sf_dir).where(F.col("CustomerID").cast("string") == F.lit(CUSTOMER))


CUSTOMER_SQL = f"SELECT * FROM ({CLEAN_SQL}) c WHERE CAST(CustomerID AS VARCHAR) = '{CUSTOMER}'"


def pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pareto(_rfm(spark, sf_dir), 0.8, 0.2)


PARETO_SQL = f"""
WITH rfm AS ({RFM_SQL}),
c AS (SELECT CAST(CAST(Monetary AS VARCHAR) AS DECIMAL(30,10)) AS money,
             row_number() OVER (ORDER BY Monetary DESC, CustomerID) AS rk FROM rfm),
n AS (SELECT count(*) AS n FROM rfm)
SELECT CAST(sum(money) AS DOUBLE) * 0.8 AS revenue_share,
       CAST(sum(CASE WHEN rk <= (SELECT CAST(floor(n * 0.2) AS BIGINT) FROM n) THEN money END) AS DOUBLE)
           AS top_revenue,
       count(*) AS customers,
       (SELECT CAST(floor(n * 0.2) AS BIGINT) FROM n) AS top_customers
FROM c
"""


def quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 (exact): quartiles of the three RFM measures, one row each."""
    r = _rfm(spark, sf_dir).checkpoint(eager=True)
    q = quantiles(r, R.RFM_COLUMNS, R.QUARTILES, RFM_EXACT)
    rows = [(c, *q[c]) for c in R.RFM_COLUMNS]
    # The three cut points per measure are the whole result: a 3-row table.
    return spark.createDataFrame(rows, "measure string, q25 double, q50 double, q75 double")


QUARTILES_SQL = f"""
WITH rfm AS ({RFM_SQL})
SELECT 'Recency' AS measure, CAST(quantile_disc(Recency, 0.25) AS DOUBLE) AS q25,
       CAST(quantile_disc(Recency, 0.5) AS DOUBLE) AS q50, CAST(quantile_disc(Recency, 0.75) AS DOUBLE) AS q75 FROM rfm
UNION ALL
SELECT 'Frequency', quantile_disc(Frequency, 0.25), quantile_disc(Frequency, 0.5), quantile_disc(Frequency, 0.75) FROM rfm
UNION ALL
SELECT 'Monetary', quantile_disc(Monetary, 0.25), quantile_disc(Monetary, 0.5), quantile_disc(Monetary, 0.75) FROM rfm
"""


APPROX_ERROR = 0.05  # the reference's setting


def quartiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 at relative error 0.05: per measure, whether each cut point's rank
    is within the error of its quantile."""
    r = _rfm(spark, sf_dir).checkpoint(eager=True)
    cuts = quantiles(r, R.RFM_COLUMNS, R.QUARTILES, APPROX_ERROR)
    n = F.count(F.lit(1))
    near = []
    for c in R.RFM_COLUMNS:
        ok = F.lit(True)
        for p, v in zip(R.QUARTILES, cuts[c]):
            below, upto = F.count_if(F.col(c) < v), F.count_if(F.col(c) <= v)
            ok = ok & (upto >= F.floor((p - APPROX_ERROR) * n)) & (below <= F.ceil((p + APPROX_ERROR) * n))
        near.append(F.struct(F.lit(c).alias("measure"), ok.alias("within"), n.alias("customers")))
    return r.agg(F.array(*near).alias("a")).select(F.explode("a").alias("a")).select("a.*")


QUARTILES_APPROX_SQL = f"""
WITH rfm AS ({RFM_SQL})
SELECT m AS measure, true AS within, (SELECT count(*) FROM rfm) AS customers
FROM (VALUES ('Recency'), ('Frequency'), ('Monetary')) t(m)
"""


def top_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 + O3: the five customers of the highest RFM score, best value first."""
    scored = R.rfm_score(_rfm(spark, sf_dir), RFM_EXACT)
    return scored.orderBy(F.desc("RFMScore"), F.desc("Monetary"), "CustomerID").limit(5)


TOP_SCORE_SQL = _score_sql("SELECT * FROM scored ORDER BY RFMScore DESC, Monetary DESC, CustomerID LIMIT 5")


def lowest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + O5: ``take`` of an ascending sort: the five smallest lines (a top-k,
    so five rows reach the driver)."""
    cols = ["Quantity", "InvoiceNo", "StockCode"]
    lines = _clean(spark, sf_dir).select(*cols)
    return spark.createDataFrame(lines.orderBy(*cols).take(5), lines.schema)


LOWEST_SQL = f"SELECT Quantity, InvoiceNo, StockCode FROM ({CLEAN_SQL}) c ORDER BY 1, 2, 3 LIMIT 5"


def rfm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rfm_score(_rfm(spark, sf_dir), RFM_EXACT)


RFM_SCORE_SQL = _score_sql("SELECT * FROM scored")


def rfm_score_udf_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm_score_udf(_rfm(spark, sf_dir), RFM_EXACT)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.segments(R.rfm_score(_rfm(spark, sf_dir), RFM_EXACT))


SEGMENTS_SQL = _score_sql(
    """
SELECT count(CustomerID) FILTER (WHERE RFMScore = '444') AS best_customers,
       count(CustomerID) FILTER (WHERE F_Quartile = 4) AS loyal_customers,
       count(CustomerID) FILTER (WHERE M_Quartile = 4) AS big_spenders,
       count(CustomerID) FILTER (WHERE RFMScore = '244') AS almost_lost,
       count(CustomerID) FILTER (WHERE RFMScore = '144') AS lost_customers,
       count(CustomerID) FILTER (WHERE RFMScore = '111') AS lost_cheap_customers
FROM scored
"""
)


def udf_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4-style raw text column (from customer) through P2 + U4 + X5."""
    raw = load(spark, sf_dir, "customer").select(F.concat_ws(",", "c_name", "c_mktsegment").alias("raw"))
    return split_with_udf(raw)


UDF_SPLIT_SQL = "SELECT c_name AS name, c_mktsegment AS company FROM customer"


# --------------------------------------------------------------------- ticks

TICKS_V = """
SELECT event_type AS key, event_id AS seq, value AS x, date_trunc('second', ts) AS t, ts
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
"""


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.parse_ticks(FX.tick_records(spark, sf_dir), "value", seq_col="event_id")


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.tick_values(_parsed(spark, sf_dir))


def tick_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.indicator_rows(_parsed(spark, sf_dir))


TICK_INDEXES_SQL = """
SELECT event_type AS key, 'AMO' AS type, value * 10 AS value, strftime(ts, '%H:%M:%S') AS split
FROM events WHERE event_id % 97 <> 0
UNION ALL
SELECT event_type, 'OBV', value, strftime(ts, '%H:%M:%S') FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
"""


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies to tick records, shown as their parsed fields."""
    recs = TK.feed_to_ticks(FX.feed_bodies(spark, sf_dir))
    f = F.col("fields")
    return recs.select(
        F.get(f, 0).alias("key"),
        F.get(f, 1).cast("long").alias("seq"),
        F.get(f, 11).try_cast("double").alias("obv"),
        F.get(f, 12).try_cast("double").alias("amo"),
        F.get(f, 31).alias("day"),
        F.get(f, 32).alias("time"),
    )


FEED_LINES_SQL = """
SELECT event_type AS key, event_id AS seq,
       CASE WHEN event_id % 89 = 0 THEN NULL ELSE value END AS obv, value * 10 AS amo,
       strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS time
FROM events WHERE event_id % 97 <> 0
"""


def tumble_26m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.window_stats(_values(spark, sf_dir), "26 minutes")


TUMBLE_SQL = f"""
WITH v AS ({TICKS_V})
SELECT key, time_bucket(INTERVAL 26 MINUTE, t, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL 26 MINUTE, t, TIMESTAMP '1970-01-01') + INTERVAL 26 MINUTE AS window_end,
       count(*) AS n, CAST(sum(CAST(CAST(x AS VARCHAR) AS DECIMAL(28,10))) AS DOUBLE) AS total
FROM v GROUP BY ALL
"""


def slide_26m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.window_stats(_values(spark, sf_dir), "26 minutes", "1 minute")


SLIDE_WINDOWS_V = f"""
SELECT key, seq, x, t, unnest(generate_series(date_trunc('minute', t) - INTERVAL 25 MINUTE,
                                             date_trunc('minute', t), INTERVAL 1 MINUTE)) AS ws
FROM ({TICKS_V}) v
"""

SLIDE_SQL = f"""
SELECT key, ws AS window_start, ws + INTERVAL 26 MINUTE AS window_end, count(*) AS n,
       CAST(sum(CAST(CAST(x AS VARCHAR) AS DECIMAL(28,10))) AS DOUBLE) AS total
FROM ({SLIDE_WINDOWS_V}) w GROUP BY ALL
"""


def ema_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.ema_by_key(_values(spark, sf_dir))


# The oracle folds the ordered list sequentially (the reference's loop), an
# independent check of the weighted-sum form.
_FOLD = (
    "list_reduce({xs}, lambda a, b: {{'e': b.x * b.k + a.e * (1 - b.k), 'x': b.x, 'k': b.k}}, "
    "{{'e': {xs}[1].x, 'x': {xs}[1].x, 'k': {xs}[1].k}}).e"
)


def _fold(xs: str) -> str:
    return _FOLD.format(xs=xs)


EMA_SQL = f"""
WITH v AS ({TICKS_V}),
l AS (SELECT key, count(*) AS n, list(x ORDER BY t, seq) AS xs FROM v GROUP BY key),
s AS (SELECT key, n,
             list_transform(xs, lambda x: {{'e': x, 'x': x, 'k': 2.0 / (len(xs) + 1)}}) AS all_x,
             list_transform(xs[1:12], lambda x: {{'e': x, 'x': x, 'k': 2.0 / (len(xs[1:12]) + 1)}}) AS short_x
      FROM l)
SELECT key, n, round({_fold('short_x')}, 6) AS ema_short, round({_fold('all_x')}, 6) AS ema_all,
       round({_fold('short_x')} - {_fold('all_x')}, 6) AS macd
FROM s
"""


def macd_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, s = MACD_WINDOW
    return TK.macd_windows(_values(spark, sf_dir), w, s)


MACD_SQL = f"""
WITH v AS ({TICKS_V}),
w AS (SELECT key, seq, x, t,
             unnest(generate_series(time_bucket(INTERVAL 30 MINUTE, t, TIMESTAMP '1970-01-01') - INTERVAL 750 MINUTE,
                                    time_bucket(INTERVAL 30 MINUTE, t, TIMESTAMP '1970-01-01'),
                                    INTERVAL 30 MINUTE)) AS ws
      FROM v),
l AS (SELECT key, ws, count(*) AS n, min(t) AS t0, list(x ORDER BY t, seq) AS xs FROM w GROUP BY key, ws),
s AS (SELECT key, ws, n, t0,
             list_transform(xs, lambda x: {{'e': x, 'x': x, 'k': 2.0 / (len(xs) + 1)}}) AS all_x,
             list_transform(xs[1:12], lambda x: {{'e': x, 'x': x, 'k': 2.0 / (len(xs[1:12]) + 1)}}) AS short_x
      FROM l)
SELECT key, ws AS window_start, ws + INTERVAL 780 MINUTE AS window_end, n, 'MACD' AS type,
       round({_fold('short_x')} - {_fold('all_x')}, 6) AS value, strftime(t0, '%H:%M:%S') AS split
FROM s
"""


STREAM_MACD_RECORDS_SQL = f"SELECT key, 'MACD' AS type, value, split FROM ({MACD_SQL}) m"


def array_concat_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key and 26-minute window, the concatenated arrays of the
    ticks' sequence numbers in chunks of one minute, as text."""
    g = TK.concat_groups(_parsed(spark, sf_dir), "26 minutes", item=F.array(F.col("seq").cast("string")))
    return g.select(
        "key", "window_start", "part", "chunk", F.size("items").alias("n_items"), F.array_join(F.sort_array("items"), ",").alias("items")
    )


CONCAT_SQL = f"""
WITH t AS (SELECT event_type AS key, event_id, date_trunc('second', ts) AS t,
                  time_bucket(INTERVAL 26 MINUTE, date_trunc('second', ts), TIMESTAMP '1970-01-01') AS window_start
           FROM events WHERE event_id % 97 <> 0),
p AS (SELECT *, CAST(date_diff('minute', window_start, date_trunc('minute', t)) AS INTEGER) AS part FROM t),
c AS (SELECT *, CAST((row_number() OVER (PARTITION BY key, window_start, part ORDER BY t, event_id) - 1) // {TK.CHUNK}
                     AS INTEGER) AS chunk FROM p)
SELECT key, window_start, part, chunk, CAST(count(*) AS INTEGER) AS n_items,
       array_to_string(list_sort(list(CAST(event_id AS VARCHAR))), ',') AS items
FROM c GROUP BY ALL
"""


def macd_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 at the reference's own window, 26 minutes sliding by one, over ticks
    made dense: the events' times folded into one day (their order kept by the
    sequence), so that windows hold many ticks."""
    v = _values(spark, sf_dir)
    day = F.unix_seconds(F.col("event_time").cast("timestamp")) % 86400
    return TK.macd_windows(v.withColumn("event_time", F.timestamp_seconds(day)), "26 minutes", "1 minute")


MACD_DENSE_SQL = f"""
WITH v AS (SELECT key, seq, x, TIMESTAMP '1970-01-01' + to_seconds(epoch(t)::BIGINT % 86400) AS t FROM ({TICKS_V}) q),
w AS (SELECT key, seq, x, t, unnest(generate_series(date_trunc('minute', t) - INTERVAL 25 MINUTE, date_trunc('minute', t),
                                                    INTERVAL 1 MINUTE)) AS ws FROM v),
l AS (SELECT key, ws, count(*) AS n, min(t) AS t0, list(x ORDER BY t, seq) AS xs FROM w GROUP BY key, ws),
s AS (SELECT key, ws, n, t0,
             list_transform(xs, lambda x: {{'e': x, 'x': x, 'k': 2.0 / (len(xs) + 1)}}) AS all_x,
             list_transform(xs[1:12], lambda x: {{'e': x, 'x': x, 'k': 2.0 / (len(xs[1:12]) + 1)}}) AS short_x
      FROM l)
SELECT key, ws AS window_start, ws + INTERVAL 26 MINUTE AS window_end, n, 'MACD' AS type,
       round({_fold('short_x')} - {_fold('all_x')}, 6) AS value, strftime(t0, '%H:%M:%S') AS split
FROM s
"""


# ------------------------------------------------------- statistics, words, CDC


def stats_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten_statistics(FX.statistics_messages(spark, sf_dir))
    return rows.withColumn("quotaType", F.to_json("quotaType"))


STATS_SQL = """
SELECT value, event_type AS quotaName, '[]' AS quotaType,
       CASE WHEN code LIKE '%hg%' THEN '全国' ELSE 'TODO' END AS object,
       CASE WHEN code LIKE '%yd%' THEN '月度' WHEN code LIKE '%jd%' THEN '季度' ELSE '年度' END AS period,
       strftime(ts, '%Y-%m-%d') AS date, code AS columnName, 'data.stats.gov.cn' AS source
FROM (SELECT *, ['hgyd', 'hgjd', 'fsnd', 'csyd'][user_id % 4 + 1] AS code FROM events) e
WHERE value >= 1.0 AND event_type IN ('click', 'view', 'purchase')
"""


def word_count_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9 over documents, dealt over the session's shuffle partitions as the
    driver's file has one row group (leave ``deal`` out for files of many)."""
    return word_count(load(spark, sf_dir, "documents"), "text", deal=int(spark.conf.get("spark.sql.shuffle.partitions")))


_SEP = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+"
WORD_COUNT_SQL = f"""
WITH t AS (SELECT lower(text) AS s FROM documents),
u AS (SELECT s, regexp_replace(s, '{_SEP}$', '') AS st FROM t),
w AS (SELECT unnest(CASE WHEN s <> '' AND st = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(st, '{_SEP}') END)
             AS word FROM u)
SELECT word, count(*) AS count FROM w GROUP BY word
"""


def cdc_decode_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = cdc_decode(FX.change_events(spark, sf_dir))
    return d.select(
        "op",
        "id",
        F.col("before.email").alias("before_email"),
        F.col("after.email").alias("after_email"),
        F.col("after.first_name").alias("after_first_name"),
        "ts_ms",
        "file",
        "pos",
        "row",
    )


_EMAIL = "'cust' || CAST(o_custkey AS VARCHAR) || '@example.com'"
_EMAIL_U = "'cust' || CAST(o_custkey AS VARCHAR) || '+u@example.com'"
CDC_DECODE_SQL = f"""
SELECT 'c' AS op, CAST(o_orderkey AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS before_email, {_EMAIL} AS after_email,
       o_orderstatus AS after_first_name, epoch_ms(o_orderdate) AS ts_ms, 'changes.000017' AS file,
       o_orderkey * 10 AS pos, 0 AS row FROM orders
UNION ALL
SELECT 'u', CAST(o_orderkey AS BIGINT), {_EMAIL}, {_EMAIL_U}, 'U', epoch_ms(o_orderdate) + 86400000,
       'changes.000017', o_orderkey * 10 + 1, 1 FROM orders WHERE o_orderkey % 3 = 0
UNION ALL
SELECT 'd', CAST(o_orderkey AS BIGINT), CASE WHEN o_orderkey % 3 = 0 THEN {_EMAIL_U} ELSE {_EMAIL} END, NULL, NULL,
       epoch_ms(o_orderdate) + 172800000, 'changes.000017', o_orderkey * 10 + 2, 2 FROM orders WHERE o_orderkey % 7 = 0
"""


def cdc_apply_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc_apply(cdc_decode(FX.change_events(spark, sf_dir)))


CDC_APPLY_SQL = f"""
SELECT CAST(o_orderkey AS BIGINT) AS id,
       CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS first_name,
       o_orderpriority AS last_name,
       CASE WHEN o_orderkey % 3 = 0 THEN {_EMAIL_U} ELSE {_EMAIL} END AS email
FROM orders WHERE o_orderkey % 7 <> 0
"""


# ---------------------------------------------------------- formats and tables


ORDER_COLUMNS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


def formats_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written and read back as Parquet, ORC, JSON, CSV and text."""
    names = [c.split()[0] for c in ORDER_COLUMNS.split(", ")]
    orders = load(spark, sf_dir, "orders").select(*names)
    parts = []
    for fmt in ("parquet", "orc", "json", "csv"):
        path = scratch_path(spark, f"orders-{fmt}")
        header = {"header": "true"} if fmt == "csv" else {}
        write_format(orders, fmt, path, **header)
        parts.append(read_format(spark, fmt, path, schema=ORDER_COLUMNS, **header).select(F.lit(fmt).alias("format"), *names))
    path = scratch_path(spark, "orders-text")
    write_format(orders.select(F.concat_ws("|", *names).alias("value")), "text", path)
    f = F.split(F.col("value"), r"\|", -1)
    typed = [F.get(f, i).cast(c.split()[1]).alias(c.split()[0]) for i, c in enumerate(ORDER_COLUMNS.split(", "))]
    parts.append(read_format(spark, "text", path).select(F.lit("text").alias("format"), *typed))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


FORMATS_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS format, CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, "
    "CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders"
    for f in ("parquet", "orc", "json", "csv", "text")
)


DAILY_SCHEMA = "key string, event_id bigint, user_id bigint, value double"


def csv_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as CSV files by day, and the glob over all days
    scanned with a declared schema: ticks, users and total per key."""
    path = scratch_path(spark, "daily")
    ev = load(spark, sf_dir, "events").select(F.col("event_type").alias("key"), "event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    # one file per day
    ev.repartition("day").write.partitionBy("day").option("header", "true").csv(path)
    days = csv_scan(spark, f"{path}/day=*/*.csv", schema=DAILY_SCHEMA)
    total = F.sum(F.col("value").cast("decimal(28,10)")).cast("double")
    return days.groupBy("key").agg(F.count(F.lit(1)).alias("ticks"), F.count_distinct("user_id").alias("users"), F.max("event_id").alias("last"), total.alias("total"))


CSV_DAILY_SQL = """
SELECT event_type AS key, count(*) AS ticks, count(DISTINCT user_id) AS users, max(event_id) AS last,
       CAST(sum(CAST(CAST(value AS VARCHAR) AS DECIMAL(28,10))) AS DOUBLE) AS total
FROM events GROUP BY 1
"""


def stats_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 + K1 + K2: statistics messages flattened and appended to a table of
    the catalog, read back."""
    table = C.create_table(spark, "quire_db", f"quota_{uuid.uuid4().hex[:8]}", QUOTA_DDL, location=scratch_path(spark, "warehouse"))
    C.append_table(flatten_statistics(FX.statistics_messages(spark, sf_dir)), table)
    return spark.table(table).withColumn("quotaType", F.to_json("quotaType"))


def hive_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K2: create a database and a table (with an array column) if
    absent, append region rows, read the table back. Each run uses a table of
    its own, so repeated runs in one session do not append twice."""
    region = load(spark, sf_dir, "region")
    table = C.create_table(
        spark,
        "quire_db",
        f"region_copy_{uuid.uuid4().hex[:8]}",
        "r_regionkey INT, r_name STRING, name_parts ARRAY<STRING>",
        location=scratch_path(spark, "warehouse"),
    )
    C.append_table(region.select("r_regionkey", "r_name", F.split("r_name", " ").alias("name_parts")), table)
    return spark.table(table).select("r_regionkey", "r_name", F.array_join("name_parts", " ").alias("name_parts"))


HIVE_SQL = "SELECT r_regionkey, r_name, r_name AS name_parts FROM region"


# --------------------------------------------------------------------- registry

FEED_DAY = "2024-01-15"


def feed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B10 + P14: the feed's ticks of one day."""
    f = F.col("fields")
    recs = TK.feed_to_ticks(FX.feed_bodies(spark, sf_dir), day=FEED_DAY)
    return recs.select(F.get(f, 0).alias("key"), F.get(f, 1).cast("long").alias("seq"), F.get(f, 31).alias("day"))


FEED_DAY_SQL = f"SELECT key, seq, day FROM ({FEED_LINES_SQL}) f WHERE day = '{FEED_DAY}'"


def rfm_score_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 + U2: RFM scores by a function defined in SQL."""
    r = _rfm(spark, sf_dir).checkpoint(eager=True)
    return rfm_score_sql(spark, r, R.rfm_quartiles(r, RFM_EXACT))


QUERIES: dict[str, Query] = {
    "csv_flight_top5_df": csv_flight_top5_df,
    "csv_flight_top5_sql": csv_flight_top5_sql,
    "range_even": range_even,
    "clean_tx": clean_tx,
    "distinct_counts": distinct_counts,
    "distinct_counts_sql": distinct_counts_sql,
    "basic_aggs": basic_aggs,
    "spread_aggs": spread_aggs,
    "collect_aggs": collect_aggs,
    "collect_countries": collect_countries,
    "approx_distinct": approx_distinct,
    "group_two_keys": group_two_keys,
    "last_purchase": last_purchase,
    "rfm": rfm,
    "rfm_joined": rfm_joined,
    "rfm_invoices": rfm_invoices,
    "customer_lines": customer_lines,
    "pareto": pareto,
    "quartiles": quartiles,
    "quartiles_approx": quartiles_approx,
    "top_score": top_score,
    "lowest_lines": lowest_lines,
    "macd_dense": macd_dense,
    "csv_daily": csv_daily,
    "stats_table": stats_table,
    "stream_word_text": ST.stream_word_text,
    "stream_stats": ST.stream_stats,
    "stream_macd_records": ST.stream_macd_records,
    "rfm_score": rfm_score,
    "rfm_score_udf": rfm_score_udf_q,
    "segments": segments,
    "udf_split": udf_split,
    "tick_indexes": tick_indexes,
    "feed_lines": feed_lines,
    "tumble_26m": tumble_26m,
    "slide_26m": slide_26m,
    "ema_by_key": ema_by_key,
    "macd_window": macd_window,
    "array_concat_groups": array_concat_groups,
    "stats_flatten": stats_flatten,
    "word_count": word_count_q,
    "cdc_decode": cdc_decode_q,
    "cdc_apply": cdc_apply_q,
    "formats_roundtrip": formats_roundtrip,
    "hive_append": hive_append,
    "stream_memory": ST.stream_memory,
    "stream_word_count": ST.stream_word_count,
    "stream_slide_append": ST.stream_slide_append,
    "stream_fanout": ST.stream_fanout,
    "stream_macd": ST.stream_macd,
    "stream_bars": ST.stream_bars,
    "stream_progress": ST.stream_progress,
    "feed_day": feed_day,
    "rfm_score_functions": rfm_score_functions,
    **FT.QUERIES,
    "stream_cdc": ST.stream_cdc,
}

ORACLES: dict[str, str] = {
    "csv_flight_top5_df": FLIGHT_TOP5_SQL,
    "csv_flight_top5_sql": FLIGHT_TOP5_SQL,
    "range_even": RANGE_EVEN_SQL,
    "clean_tx": CLEAN_SQL,
    "distinct_counts": DISTINCT_SQL,
    "distinct_counts_sql": DISTINCT_SQL,
    "basic_aggs": BASIC_SQL,
    "spread_aggs": SPREAD_SQL,
    "collect_aggs": COLLECT_SQL,
    "collect_countries": COLLECT_COUNTRIES_SQL,
    "group_two_keys": GROUP_TWO_SQL,
    "last_purchase": LAST_PURCHASE_SQL,
    "rfm": RFM_SQL,
    "rfm_joined": RFM_SQL,
    "rfm_invoices": RFM_INVOICES_SQL,
    "customer_lines": CUSTOMER_SQL,
    "pareto": PARETO_SQL,
    "quartiles": QUARTILES_SQL,
    "approx_distinct": APPROX_SQL,
    "quartiles_approx": QUARTILES_APPROX_SQL,
    "top_score": TOP_SCORE_SQL,
    "lowest_lines": LOWEST_SQL,
    "macd_dense": MACD_DENSE_SQL,
    "csv_daily": CSV_DAILY_SQL,
    "stats_table": STATS_SQL,
    "stream_word_text": f"SELECT word AS key, CAST(count AS VARCHAR) AS value FROM ({WORD_COUNT_SQL}) w",
    "stream_stats": STATS_SQL,
    "stream_macd_records": STREAM_MACD_RECORDS_SQL,
    "rfm_score": RFM_SCORE_SQL,
    "rfm_score_udf": RFM_SCORE_SQL,
    "segments": SEGMENTS_SQL,
    "udf_split": UDF_SPLIT_SQL,
    "tick_indexes": TICK_INDEXES_SQL,
    "feed_lines": FEED_LINES_SQL,
    "tumble_26m": TUMBLE_SQL,
    "slide_26m": SLIDE_SQL,
    "ema_by_key": EMA_SQL,
    "macd_window": MACD_SQL,
    "array_concat_groups": CONCAT_SQL,
    "stats_flatten": STATS_SQL,
    "word_count": WORD_COUNT_SQL,
    "cdc_decode": CDC_DECODE_SQL,
    "cdc_apply": CDC_APPLY_SQL,
    "formats_roundtrip": FORMATS_SQL,
    "hive_append": HIVE_SQL,
    "stream_memory": ST.STREAM_MEMORY_SQL,
    "stream_word_count": WORD_COUNT_SQL,
    "stream_slide_append": ST.STREAM_SLIDE_SQL,
    "stream_fanout": ST.STREAM_FANOUT_SQL,
    "stream_macd": MACD_SQL,
    "stream_bars": ST.STREAM_BARS_SQL,
    "stream_progress": ST.STREAM_PROGRESS_SQL,
    "feed_day": FEED_DAY_SQL,
    "rfm_score_functions": RFM_SCORE_SQL,
    "stats_sql": STATS_SQL,
    **FT.ORACLES,
    "stream_cdc": CDC_APPLY_SQL,
}
