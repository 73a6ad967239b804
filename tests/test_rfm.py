from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import aggregates as A
from quire.operators import rfm as R
from quire.operators.ranking import exact_quantiles, global_row_number, top_fraction
from quire.operators.udfs import rfm_score_udf
from quire.sources.files import csv_scan

UK = "United Kingdom"
HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
COLUMNS = "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp, UnitPrice double, CustomerID long, Country string"


def _lines(days=4, per_day=60):
    """Invented sales lines, by day."""
    rnd = random.Random(1)
    out = []
    for d in range(days):
        for i in range(per_day):
            customer = "" if i % 13 == 0 else str(1000 + rnd.randrange(9))
            country = UK if i % 5 else "Spain"
            quantity = rnd.choice([-2, 1, 2, 5, 12])
            price = rnd.choice([0.001, 0.125, 0.85, 2.5, 19.99])
            out.append((d, f"{d}{i // 3:03d}", f"S{rnd.randrange(30)}", f"thing, no {i}", quantity, f"2011-01-0{d + 1} 0{i % 9}:{i % 60:02d}:00", price, customer, country))
    return out


def _retail(spark, tmp_path):
    """The lines as daily CSV files (quoted commas), scanned by a glob."""
    for d in range(4):
        rows = [",".join([r[1], r[2], f'"{r[3]}"', str(r[4]), r[5], str(r[6]), r[7], r[8]]) for r in _lines() if r[0] == d]
        (tmp_path / f"day{d}.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    return csv_scan(spark, str(tmp_path / "*.csv"), repartition=3)


def _cleaned():
    return [r for r in _lines() if r[8] == UK and r[4] > 0 and r[7] and r[5] > "2011-01-02 00:00:00"]


def test_csv_glob_and_aggregates(spark, tmp_path):
    df = _retail(spark, tmp_path)
    rows = _lines()
    assert dict(df.dtypes)["Quantity"] == "int" and dict(df.dtypes)["UnitPrice"] == "double" and df.rdd.getNumPartitions() == 3
    r = df.agg(F.count("StockCode"), F.count_distinct("StockCode"), F.min("Quantity"), F.max("Quantity"), F.sum("Quantity"), F.sum_distinct(F.col("Quantity"))).first()
    q = [x[4] for x in rows]
    assert tuple(r) == (len(rows), len({x[2] for x in rows}), min(q), max(q), sum(q), sum(set(q)))
    s = A.spread_aggs(df, digits=8).first()
    assert abs(s.var_pop - np.var(q)) < 1e-6 and abs(s.stddev_samp - np.std(q, ddof=1)) < 1e-6
    assert A.group_two_keys(df).count() == len({(x[1], x[7]) for x in rows})
    a = A.approx_distinct_checked(df, "StockCode", 0.1).first()
    assert a.within and a.exact == len({x[2] for x in rows})
    assert A.approx_distinct(df, "StockCode", 0.1).first()[0] > 0
    assert df.filter(F.col("Description").contains(",")).count() == len(rows)


def test_clean_and_rfm_by_brute_force(spark, tmp_path):
    clean = R.clean_transactions(_retail(spark, tmp_path), UK, "2011-01-02").cache()
    want = {}
    for r in _cleaned():
        w = want.setdefault(int(r[7]), ["", 0, Decimal(0), set()])
        w[0], w[1], w[2] = max(w[0], r[5][:10]), w[1] + 1, w[2] + Decimal(str(r[6])) * r[4]
        w[3].add(r[1])
    assert clean.count() == len(_cleaned())
    got = R.rfm(clean, "2011-02-01")
    table = {r.CustomerID: (r.Recency, r.Frequency, r.Monetary) for r in got.collect()}
    assert table == {c: ((date(2011, 2, 1) - date.fromisoformat(w[0])).days, w[1], float(w[2])) for c, w in want.items()}
    assert {r.CustomerID: r.Frequency for r in R.rfm(clean, "2011-02-01", "invoices").collect()} == {c: len(w[3]) for c, w in want.items()}
    assert sorted(map(tuple, R.rfm_joined(clean, "2011-02-01").collect())) == sorted(map(tuple, got.collect()))
    p = R.pareto(got).first()
    money = sorted((w[2] for w in want.values()), reverse=True)
    k = int(0.2 * len(money))
    assert p.top_customers == k and p.top_revenue == float(sum(money[:k])) and abs(p.revenue_share - 0.8 * float(sum(money))) < 1e-9
    a = sorted(map(tuple, R.rfm_score(got, 0.0).collect()))
    assert a == sorted(map(tuple, rfm_score_udf(got, 0.0).collect()))
    assert R.segments(R.rfm_score(got, 0.05)).count() == 1


def test_money_is_not_rounded_and_ids_are_wide(spark):
    big = 3_000_000_000
    rows = [(str(i), "s", "d", 1, datetime(2011, 1, 2, 1), 0.001, big, UK) for i in range(1000)]
    rows += [(str(i), "s", "d", 1, datetime(2011, 1, 2, 1), 0.125, big + 1, UK) for i in range(10)]
    clean = R.clean_transactions(spark.createDataFrame(rows, COLUMNS), UK, "2010-12-09")
    got = {r.CustomerID: r.Monetary for r in R.rfm(clean, "2011-02-01").collect()}
    assert got == {big: 1.0, big + 1: 1.25}


def test_midnight_is_not_after(spark):
    # Strict timestamp comparison; an invoice at midnight of the cut day is out.
    rows = [("1", "s", "d", 1, "2010-12-09 00:00:00", 1.0, 1.0, UK), ("2", "s", "d", 1, "2010-12-09 00:00:01", 1.0, 1.0, UK)]
    df = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Description string, Quantity int, "
                               "InvoiceDate string, UnitPrice double, CustomerID double, Country string")
    df = df.withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp"))
    assert [r.InvoiceNo for r in R.clean_transactions(df, UK, "2010-12-09").collect()] == ["2"]


def test_global_row_number_matches_window(spark):
    rnd = random.Random(7)
    # one key holds a third of the rows
    rows = [(("hot" if i % 3 == 0 else f"k{rnd.randint(0, 50)}"), rnd.random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double, id long")
    got = global_row_number(df, ["k", "v", "id"], partitions=7).select("id", "rn")
    want = df.select("id", F.row_number().over(Window.orderBy("k", "v", "id")).alias("rn"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_top_fraction_and_exact_quantiles(spark):
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 200)) for _ in range(1001)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v double, id long")
    top, k = top_fraction(df, [F.desc("v"), F.asc("id")], 0.2)
    assert k == 200
    want = sorted(enumerate(vals), key=lambda t: (-t[1], t[0]))[:200]
    assert sorted(r.id for r in top.collect()) == sorted(i for i, _ in want)
    q = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])["v"]
    s = np.sort(np.array(vals))
    assert q == [float(s[int(np.ceil(p * len(s))) - 1]) for p in (0.25, 0.5, 0.75)]
    assert q == df.approxQuantile("v", [0.25, 0.5, 0.75], 0.0)


def test_exact_quantiles_heavy_duplicates_and_nulls(spark):
    rnd = random.Random(5)
    vals = [0.0 if i % 3 == 0 else float(rnd.randint(1, 40)) for i in range(900)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = exact_quantiles(df, ["v"], [0.1, 0.25, 0.5, 0.75, 1.0])["v"]
    s = np.sort(np.array([v for v in vals if v is not None]))
    assert got == [float(s[int(np.ceil(p * len(s))) - 1]) for p in (0.1, 0.25, 0.5, 0.75, 1.0)]
    assert got == df.approxQuantile("v", [0.1, 0.25, 0.5, 0.75, 1.0], 0.0)
